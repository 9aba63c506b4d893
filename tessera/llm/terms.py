"""Hashed terms of texts: each distinct word once, with its beginnings, as numbers of a table."""

from __future__ import annotations

import numpy as np

from tessera.llm import textscan

#: Beginnings of a word, in bytes, that are terms beside the word itself.
PREFIXES = (4, 5, 6)


def hashed_terms(parts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**bits of the distinct terms of all texts, text after text, and where each text's begin (with the end appended)."""
    data, starts, ends, hashes, first = textscan.words(parts, textscan.ALNUM)
    doc = np.repeat(np.arange(len(parts)), np.diff(first))
    terms, owners = [hashes], [doc]
    for k in PREFIXES:
        long_ = np.flatnonzero(ends - starts > k)
        if long_.size:
            terms.append(textscan.mix64(textscan.span_hashes(data, starts[long_], starts[long_] + k) + np.uint64(k)))
            owners.append(doc[long_])
    number = (np.concatenate(terms) >> np.uint64(64 - bits)).astype(np.int64)
    pairs = np.unique((np.concatenate(owners) << bits) | number)
    return pairs & ((1 << bits) - 1), np.searchsorted(pairs >> bits, np.arange(len(parts) + 1))
