"""Launch-uptake segmentation on Spark: who took up a product how soon after its launch."""
