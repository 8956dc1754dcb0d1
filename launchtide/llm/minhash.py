"""One-permutation MinHash of shingle sets, with optimal densification.

A shingle's hash is its own random permutation: the top bits name one of ``n_bins`` bins,
and each bin keeps its least hash, so one pass fills all bins. An empty bin takes the
value of the first filled bin along a random order of the others that is its own, the
same for every set. Two sets then agree in each bin with the chance of their Jaccard
similarity, however few shingles they have.
"""

from __future__ import annotations

import numpy as np

from launchtide.llm.words import Kept, mix

_orders = Kept()


def probe_order(n_bins: int) -> np.ndarray:
    """For each bin, all bins in the order in which an empty one asks them."""
    if n_bins not in _orders:
        each = np.arange(n_bins * n_bins, dtype=np.uint64).reshape(n_bins, n_bins)
        keys = mix(each * np.uint64(0xD1342543DE82EF95) + np.uint64(n_bins))
        _orders[n_bins] = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
    return _orders[n_bins]


def signatures(sets: list[np.ndarray], n_bins: int) -> np.ndarray:
    """A row of ``n_bins`` 32-bit values per sorted set; zeros for an empty set.

    ``n_bins`` is a power of two.
    """
    shift = np.uint64(64 - (n_bins.bit_length() - 1))
    values = np.zeros((len(sets), n_bins), np.uint32)
    filled = np.zeros((len(sets), n_bins), bool)
    for k, own in enumerate(sets):
        if not len(own):
            continue
        bins = (own >> shift).astype(np.int64)
        first = np.concatenate(([True], bins[1:] != bins[:-1]))
        # Mixed bits below those of the bin: their order is the order of the hashes.
        values[k, bins[first]] = (own[first] * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)
        filled[k, bins[first]] = True
    row, empty = np.nonzero(~filled & filled.any(axis=1)[:, None])
    order = probe_order(n_bins)
    for step in range(n_bins):
        if not len(row):
            break
        asked = order[empty, step]
        found = filled[row, asked]
        values[row[found], empty[found]] = values[row[found], asked[found]]
        row, empty = row[~found], empty[~found]
    return values
