"""Words of many texts at once, as codes into a list of distinct words."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PUNCTUATION = string.punctuation + "…“”„«»¿¡–—"


def coded_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, code of each word in order, bounds of each text in the codes).

    A word is a lower-case stretch without ASCII white space, freed of punctuation at both
    ends; stretches of nothing else aren't words.
    """
    parts = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
    coded = parts.flatten().dictionary_encode()
    distinct: dict[str, int] = {"": 0}
    new = np.fromiter((distinct.setdefault(w.strip(PUNCTUATION), len(distinct)) for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    codes = new[coded.indices.to_numpy()] if len(new) else np.empty(0, np.int64)
    real = codes > 0
    bounds = np.r_[0, np.cumsum(real)][parts.offsets.to_numpy()]
    return list(distinct)[1:], codes[real] - 1, bounds
