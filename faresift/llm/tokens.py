"""Token ids of whole texts with a public vocabulary file, remembered by blank-separated chunk.

The vocabulary's rules never join what white space separates, so a chunk has the same ids wherever it
stands. Only texts of characters on which all Unicode versions agree (Latin letters, common marks) go
this way; any other text, and texts that hold a special token's string, are encoded as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer, pre_tokenizers

VOCABULARY = "word_bpe_49k.json"
# Chunks kept; beyond them all are forgotten and learnt again as they come.
REMEMBERED = 400_000
# Texts that are looked at together, by their number and their characters (one text may have more).
TEXTS_AT_ONCE = 4096
CHARS_AT_ONCE = 2_000_000
WORDS_AT_ONCE = 512
# Sure are Latin letters but the dotted capital I, common punctuation and currency signs; not controls and no-break spaces.
_UNSURE_BYTES = bytes([*range(9), *range(0x0E, 0x20), *range(0x7F, 0xA1)])
_UNSURE = regex.compile(r"[\x00-\x08\x0e-\x1f\x7f-\xa0\u0130\u0250-\u200f\u2028-\u202f\u205f-\u209f\u20c0-\U0010ffff]")
# The rules that make chunks independent: composition, white space and case before, a word pattern after.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def _sure(text: str) -> bool:
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return not _UNSURE.search(text)
    return len(raw.translate(None, _UNSURE_BYTES)) == len(raw)


def parts_of(texts: list[str]) -> Iterator[slice]:
    """Slices of texts that are looked at together."""
    start = chars = 0
    for at, text in enumerate(texts):
        if at > start and (at - start >= TEXTS_AT_ONCE or chars + len(text) > CHARS_AT_ONCE):
            yield slice(start, at)
            start, chars = at, 0
        chars += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


class Chunks:
    """Ids of chunks, or words, in one array, each chunk by its number."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, "<u4")
        self.starts = np.zeros(1, np.int64)

    def add(self, chunks: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        if not chunks:
            return
        self.number.update(zip(chunks, range(len(self.number), len(self.number) + len(chunks)), strict=True))
        self.ids = np.concatenate([self.ids, *ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of these chunks one after the other, and where each chunk's begin, with the end."""
        starts = self.starts[numbers]
        sizes = self.starts[numbers + 1] - starts
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds


class Encoder:
    """Ids of texts as packed little-endian 32-bit numbers."""

    def __init__(self, path: str):
        self.path = path
        rules = json.loads(Path(path).read_text(encoding="utf-8"))
        steps = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        chunked = (
            [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])] == _NORMALIZERS
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and rules["model"].get("end_of_word_suffix")
        )
        self.specials = [t["content"] for t in rules["added_tokens"]]
        self.words, self.chunks = Chunks(), Chunks()
        self.pattern = None
        if chunked:
            self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
            del rules["normalizer"]
            self.plain = Tokenizer.from_str(json.dumps(rules | {"normalizer": None, "added_tokens": []}))
            # Words come one by one between spaces, so the pattern need not cut them out again.
            as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
            vocabulary, suffix = rules["model"]["vocab"], rules["model"]["end_of_word_suffix"]
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _learn_words(self, words: list[str]) -> None:
        ids, sizes = [], []
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            own = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[own]) + 1
            assert len(stops) == len(some), "a word without an end"
            ids.append(own)
            sizes.append(np.diff(stops, prepend=0))
        self.words.add(words, ids, sizes)

    def _learn(self, chunks: list[str]) -> None:
        """Chunks that are not known yet, by their words; each different word is encoded once."""
        words, counts = [], []
        for c in chunks:
            if c.isalpha():
                words.append(c)
                counts.append(1)
            elif c[:-1].isalpha() and c[-1] in ".,;:!?":
                words += c[:-1], c[-1]
                counts.append(2)
            else:
                own = self.pattern.findall(c)
                words += own
                counts.append(len(own))
        number = self.words.number
        self._learn_words(list({w for w in words if w not in number}))
        ids, bounds = self.words.gather(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        self.chunks.add(chunks, [ids], [np.diff(bounds[np.cumsum([0, *counts])])])

    def _by_chunks(self, texts: list[str]) -> list[bytes]:
        """Ids of texts on which all Unicode versions agree: each different chunk is looked up once, ids are gathered."""
        split = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        chunks = split.flatten().dictionary_encode()
        different = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = self.chunks.number
        found = list(map(number.get, different))
        if None in found:
            unknown = [k for k, n in enumerate(found) if n is None]
            self._learn([different[k] for k in unknown])
            for k in unknown:
                found[k] = number[different[k]]
        numbers = np.array(found, np.int64)
        ids, bounds = self.chunks.gather(numbers[chunks.indices.to_numpy()])
        ends = bounds[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def forget(self) -> None:
        self.words, self.chunks = Chunks(), Chunks()

    @cached_property
    def full(self) -> Tokenizer:
        """Read when the first text needs it; few do."""
        return Tokenizer.from_file(self.path)

    def _whole(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for part in parts_of(texts):
            some = texts[part]
            sure = [bool(self.pattern) and _sure(t) and not any(s in t for s in self.specials) for t in some]
            known = iter(self._by_chunks([t for t, s in zip(some, sure, strict=True) if s]) if any(sure) else ())
            found += [next(known) if s else self._whole(t) for t, s in zip(some, sure, strict=True)]
            if len(self.chunks.number) > REMEMBERED:
                self.forget()
        return found


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary_path(path: str | None = None) -> str:
    return path or public_tokenizers.path(VOCABULARY)
