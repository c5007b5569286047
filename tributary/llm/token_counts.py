"""Token counts of whole texts by overlap resynchronisation.

A huge text is encoded in overlapping chunks, so that the encodings (ids, offsets, words) of one chunk at a time are held. Two
neighbours are spliced at a common boundary that is proven stable:

* The tokenizers taken here normalise (canonical composition, lower case, white space), then match words from left to right
  with a pattern that looks neither back nor ahead, then merge pairs inside each word. From a word boundary on, the
  tokens depend on the text behind it only, if the character there composes with nothing in front of it ("inert").
* A chunk that begins at a boundary of the whole text has the boundaries of the whole text up to a little before its end: up to two characters
  before the last inert character that is followed by as many characters as the longest special token has.
* So a position is proven if it is such a boundary in the earlier chunk, a boundary in the later one, and inert. The later chunk is then right from there on.

If two chunks have no such position in common, the overlap is widened twofold, at last to the whole earlier chunk, which begins at a proven boundary. A single
endless word is thus encoded whole.

Shorter texts are runs of units parted by ASCII white space, which always ends a word and composes with nothing: the tokens of a text are those of its units,
and a worker encodes each unit once.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tributary.llm.blocks import small_batches
from tributary.llm.words import U, split_words, steps

#: Characters of a chunk and of an overlap at first. A text of at most a chunk in bytes isn't cut.
CHUNK, OVERLAP = 16_384, 256
TOKEN_LIMIT = 2048
#: Bytes of text worked on at once.
STEP = 2 << 20
#: Counts of units that a Python worker remembers between batches; beyond it starts anew.
REMEMBERED = 1_000_000
_counters: dict[tuple[str, int, int], "Counter"] = {}


@cache
def _composing() -> frozenset[str]:
    """Characters that may compose with one in front of them, or move behind it."""
    second = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        if unicodedata.combining(chr(c)):
            second.add(chr(c))
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            second.add(chr(int(parts[1], 16)))
    return frozenset(second)


def inert(char: str) -> bool:
    return char < "\x80" or char not in _composing()


def _must_part_at_spaces(spec: dict) -> None:
    """Refuses a tokenizer for which the proof above doesn't hold."""
    normalizer = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    kinds = {x["type"] for x in normalizer.get("normalizers", [normalizer])}
    pre = spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    split = parts[0] if parts[0].get("type") == "Split" else {}
    pattern = split.get("pattern", {}).get("Regex", "^").replace("[^", "[")  # a caret that opens a class is no anchor
    words = split.get("behavior") == "Removed" and split.get("invert") and not any(x in pattern for x in ("(?", "^", "$", "\\b", "\\B"))
    rest = all(x.get("type") == "ByteLevel" and not x.get("add_prefix_space") and not x.get("use_regex", True) for x in parts[1:])
    tokens = spec.get("added_tokens", [])
    own = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) and not any(c.isspace() for c in t["content"]) for t in tokens)
    if not (kinds <= {"NFC", "Lowercase", "Replace"} and words and rest and own and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")):
        raise ValueError("token counts need a tokenizer whose words are matched from left to right between white space")


class Counter:
    """Numbers of tokens, as the tokenizer gives them for whole texts without added special tokens."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _must_part_at_spaces(spec)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.encode(" \t\n\x0b\x0c\r", add_special_tokens=False).ids:
            raise ValueError("token counts need a tokenizer that drops white space")
        self.chunk, self.overlap = chunk, overlap
        self.special = max((len(t["content"]) for t in spec.get("added_tokens", [])), default=0)
        self.forget()

    def forget(self) -> None:
        self.unit, self.size = np.zeros(0, U), np.zeros(0, np.int64)

    def _bounds(self, text: str, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Where words begin in text[start:stop], the tokens before each, and all tokens."""
        encoded = self.tokenizer.encode(text[start:stop], add_special_tokens=False)
        word = np.array([-1 if w is None else w for w in encoded.word_ids], np.int64)
        place = np.array(encoded.offsets, np.int64).reshape(-1, 2)
        first = np.flatnonzero(np.diff(word, prepend=-2))
        # A character whose lower case is two may be parted by a word's end: that is no boundary of the text.
        ended = np.concatenate([[0], place[:-1, 1]])[: len(word)]
        first = first[ended[first] <= place[first, 0]]
        return place[first, 0] + start, first, len(word)

    def _proven(self, text: str, start: int, stop: int) -> int:
        """The last position up to which the boundaries of text[start:stop] are those of the whole text."""
        at = stop - max(self.special, 2)
        while at > start and not inert(text[at]):
            at -= 1
        return at - 2

    def resynchronised(self, text: str) -> int:
        """Tokens of one text, encoded chunk by chunk."""
        total, start, stop = 0, 0, min(self.chunk, len(text))  # start: a boundary of the whole text
        at, before, n = self._bounds(text, start, stop)
        skip = 0  # tokens of this chunk that stand before start
        while stop < len(text):
            limit, width = self._proven(text, start, stop), self.overlap
            while True:
                begin = max(start, stop - width)
                end = min(len(text), stop + max(self.chunk, width))
                next_at, next_before, next_n = self._bounds(text, begin, end)
                if begin == start:  # from a proven boundary: this chunk takes the place of the earlier one
                    skip = 0
                    break
                common = np.intersect1d(at[(at <= limit) & (at > start)], next_at)
                place = next((int(p) for p in common[::-1] if inert(text[p])), None)
                if place is not None:
                    total += int(before[np.searchsorted(at, place)]) - skip
                    start, skip = place, int(next_before[np.searchsorted(next_at, place)])
                    break
                width *= 2
            at, before, n, stop = next_at, next_before, next_n, end
        return total + n - skip

    def _unit_sizes(self, unit: np.ndarray, texts) -> np.ndarray:
        """Tokens of each distinct unit; ``texts`` gives the texts of those at the places asked for."""
        if len(self.unit) > REMEMBERED:
            self.forget()
        place = np.searchsorted(self.unit, unit)
        known = self.unit[np.minimum(place, len(self.unit) - 1)] == unit if len(self.unit) else np.zeros(len(unit), bool)
        new = np.flatnonzero(~known)
        if len(new):
            encoded = self.tokenizer.encode_batch_fast(texts(new), add_special_tokens=False)
            size = np.fromiter(map(len, encoded), np.int64, len(encoded))
            self.unit, self.size = np.insert(self.unit, place[new], unit[new]), np.insert(self.size, place[new], size)
        return self.size[np.searchsorted(self.unit, unit)]

    def short(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Tokens of each text (null: none), by its units."""
        words = split_words(texts)
        unit, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        raw = words.data.tobytes()
        start, end = words.start[first], words.end[first]
        size = self._unit_sizes(unit, lambda new: [raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())])
        return np.bincount(words.text, weights=size[inverse], minlength=words.n_texts).astype(np.int64)

    def count(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Tokens of each text (null: none)."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        huge = pc.fill_null(pc.greater(pc.binary_length(texts), self.chunk), False)
        out = self.short(pc.if_else(huge, pa.scalar("", texts.type), texts))
        for i in np.flatnonzero(huge.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.resynchronised(texts[i].as_py())
        return out


def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Counter:
    """One for each file in a Python worker."""
    key = (path, chunk, overlap)
    if key not in _counters:
        _counters[key] = Counter(*key)
    return _counters[key]


def _count(path: str, limit: int, chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for part in steps(batch, "text", STEP):
                n = counter(path, chunk, overlap).count(part["text"])
                size = pc.fill_null(pc.binary_length(part["text"]), 0).cast(pa.int64()).combine_chunks()
                yield pa.record_batch({"doc_id": part["doc_id"].combine_chunks(), "n_bytes": size, "n_tokens": n, "over_limit": n > limit})

    return run


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) of every row, in one pass without a shuffle.

    A null or empty text has no bytes and no tokens. Repeated rows and null ids are counted like any other row; other columns are ignored; an empty
    table gives no rows. Texts are encoded whole, however long; a task holds the encoding of one chunk. Strings of special tokens
    inside a text count as the tokenizer takes them by default. A tokenizer for which chunks can't be proven right is refused.
    """
    small_batches(docs.sparkSession)
    counter(tokenizer_path, chunk, overlap)  # a tokenizer that doesn't fit is refused here, not in a task
    plain = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return plain.mapInArrow(_count(tokenizer_path, limit, chunk, overlap), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
