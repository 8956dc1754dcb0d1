from launchtide.sources.lookups import read_device_lookup, read_launches
from launchtide.sources.profiles import read_profiles
from launchtide.sources.stored import read_deltas, read_histograms, read_user_sets

__all__ = [
    "read_deltas",
    "read_device_lookup",
    "read_histograms",
    "read_launches",
    "read_profiles",
    "read_user_sets",
]
