"""Token ids of whole texts, one batch of texts at a time.

A public word vocabulary drops white space before it looks at anything else, so a text's ids are those
of its parts between ASCII white space, one after another. Parts repeat: each batch encodes its distinct
ones, and the latest are kept from batch to batch. Ids of a batch then come from numpy lookups.

A part that is Latin-1 letters with ASCII punctuation behind them goes straight to the vocabulary's
merging model as two words, because for such a part every step before it is known: the letters, lower
case, and the punctuation are one word each, spelled by the vocabulary's byte characters. Any other part
passes the whole tokenizer. Both shortcuts are taken only if the file describes these very steps; for
another vocabulary file every text passes the tokenizer as a whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

CACHED_PARTS = 1 << 18  # of each of two generations
_CACHED_LENGTH = 64
# The steps of the public vocabulary file under which white space separates.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SPLIT = {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PUNCTUATION = "!-/:-@\\[-`{-~"
_PLAIN = re.compile(f"([{_LETTERS}]+)([{_PUNCTUATION}]*)").fullmatch


def _separates(path: str) -> bool:
    with open(path, encoding="utf-8") as file:
        steps = json.load(file)
    loose = any(x["lstrip"] or x["rstrip"] or x["single_word"] or re.search(r"\s", x["content"]) for x in steps["added_tokens"])
    return (
        not loose
        and (steps["normalizer"] or {}).get("normalizers") == _NORMALIZER
        and (steps["pre_tokenizer"] or {}).get("pretokenizers") == [_SPLIT, _BYTES]
        and steps["model"]["type"] == "BPE"
        and not steps["model"]["dropout"]
        and not steps["truncation"]
        and not steps["padding"]
    )


class WordCoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.separates = _separates(path)
        self.model = self.tokenizer.model
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        latin = [chr(c) for c in range(33, 256) if chr(c).isprintable()]
        self.spelling = str.maketrans({c: spelled.pre_tokenize_str(c)[0][0] for c in latin})
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        # Printable ASCII characters spell themselves.
        spelled = word if word.isascii() else word.translate(self.spelling)
        return array("I", [token.id for token in self.model.tokenize(spelled)]).tobytes()

    def _keep(self, part: str, ids: bytes) -> None:
        if len(part) <= _CACHED_LENGTH:
            if len(self.recent) >= CACHED_PARTS:
                self.older, self.recent = self.recent, {}
            self.recent[part] = ids

    def _plain(self, part: str) -> bytes | None:
        """The ids of letters with punctuation behind them; None for other parts."""
        if part.isascii() and part.isalpha():
            letters, rest = part.lower(), ""
        elif plain := _PLAIN(part):
            letters, rest = plain[1].lower(), plain[2]
        else:
            return None
        ids = self.recent.get(letters) or self.older.get(letters)
        if ids is None:
            ids = self._word(letters)
        if letters != part:
            self._keep(letters, ids)
        if rest:
            tail = self.recent.get(rest)
            if tail is None:
                tail = self._word(rest)
                self._keep(rest, tail)
            ids += tail
        return ids

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts, as bytes of unsigned 32-bit numbers."""
        out = list(map(self.recent.get, parts))
        odd = []
        for at in [at for at, ids in enumerate(out) if ids is None]:
            part = parts[at]
            ids = self.older.get(part)
            if ids is None:
                ids = self._plain(part)
            if ids is None:
                odd.append(at)
            else:
                out[at] = ids
                self._keep(part, ids)
        for at, ids in zip(odd, self._encoded([parts[at] for at in odd]), strict=True):
            out[at] = ids
            self._keep(parts[at], ids)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and the number of ids of each text."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if not self.separates:
            found = self._encoded(texts.to_pylist())
            return np.frombuffer(b"".join(found), np.uint32), np.array([len(x) // 4 for x in found], np.int64)
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        known = self._parts(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.array([len(x) // 4 for x in known], np.int64)
        table = np.frombuffer(b"".join(known), np.uint32)
        begins = np.cumsum(sizes) - sizes
        lengths = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(ends[-1]) + np.repeat((begins[codes] if len(codes) else lengths) - ends[:-1], lengths)
        borders = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)
        return table[places], np.diff(ends[borders])


_coders: dict[str, WordCoder] = {}


def coder_for(path: str) -> WordCoder:
    """The Python worker's own coder, kept from task to task."""
    if path not in _coders:
        _coders.clear()
        _coders[path] = WordCoder(path)
    return _coders[path]
