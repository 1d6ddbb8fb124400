"""Token ids of whole texts by a public word-level BPE, with a bounded cache of words."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered in a Python worker; further ones are encoded anew, so memory stays bounded.
CACHE_ENTRIES = 200_000
#: The word pattern of the tokenizer file (a fixed value), and the same for texts of ASCII and
#: Latin-1 letters only, where the classes \p{L} and \p{N} can be written out.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-öø-ÿ]+|[0-9]|[^\sa-z0-9À-öø-ÿ]+")
_NOT_LATIN = re.compile(r"[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]")


class WordEncoder:
    """Ids as `tokenizers` gives them for whole texts.

    The BPE never crosses a word, so a Latin-1 text is lower-cased and cut into the tokenizer's
    words, and each distinct word goes through the BPE model once; numpy lays the ids out. Any other text, one that
    holds an added special token, or a file with other rules is encoded whole.
    """

    def __init__(self, path: str, as_plain_text: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special: list[str] = []
        if as_plain_text:
            self.tokenizer.encode_special_tokens = True
        else:
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        rules = json.loads(self.tokenizer.to_str())
        kinds = [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])]
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and cuts[0].get("pattern") == {"Regex": WORD_PATTERN}
        self.bytes_as_text = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.cache: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        shown = word if word.isascii() and word.isalnum() else "".join(x for x, _ in self.bytes_as_text.pre_tokenize_str(word))
        return np.array([t.id for t in self.tokenizer.model.tokenize(shown)], "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a lower-case stretch without white space."""
        cache, words = self.cache, _LATIN_WORD.findall(piece)
        room = len(cache) < CACHE_ENTRIES
        out = []
        for w in words:
            ids = cache.get(w)
            if ids is None:
                ids = self.word(w)
                if room:
                    cache[w] = ids
            out.append(ids)
        return b"".join(out)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def by_pieces(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of Latin-1 texts: each distinct piece of them is looked up once, then laid out by index."""
        parts = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        coded = parts.flatten().dictionary_encode()
        cache, piece = self.cache, self.piece
        known = [cache.get(p) or piece(p) for p in coded.dictionary.to_pylist()]
        length = np.array([len(x) for x in known], np.int64) // 4
        start = np.cumsum(length) - length
        which = coded.indices.to_numpy()
        each = length[which]
        ends = np.cumsum(each)
        flat = np.frombuffer(b"".join(known), "<u4")[np.repeat(start[which] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.r_[0, ends][parts.offsets.to_numpy()]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        plain = [self.by_word and not _NOT_LATIN.search(t) and not any(s in t for s in self.special) for t in texts]
        fast = iter(self.by_pieces([t for t, p in zip(texts, plain, strict=True) if p]) if any(plain) else ())
        return [next(fast) if p else self.whole(t) for t, p in zip(texts, plain, strict=True)]


_encoders: dict[tuple[str, bool], WordEncoder] = {}


def encoder_of(path: str, as_plain_text: bool = False) -> WordEncoder:
    """The encoder of this Python worker, so that its cache serves one task after another."""
    key = (path, as_plain_text)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, as_plain_text)
    return _encoders[key]
