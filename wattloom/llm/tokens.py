"""Token ids of whole texts, computed once per distinct word of a worker.

The tokenizer splits at white space before anything else and none of its steps looks across it, so the ids of a text are
those of its chunks between ASCII white space, one after the other. Arrow splits some megabytes of text at a time and
numbers the distinct chunks. A chunk that is a plain Latin word and punctuation is cut there, as the tokenizer does, and
lower-cased, as the tokenizer does. Distinct words go straight to the tokenizer's model, all else to the whole tokenizer,
and Arrow strings the ids together. Each worker keeps ids up to a bound on their bytes, in two generations: when the young
one is full it becomes the old one, whose entries go with the next change unless they were asked for again. A tokenizer of
another make is given whole texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import text_of

END_ID = 2
# Bytes kept by a worker: ids of plain words, and of all else.
CACHED = {"words": 32 << 20, "others": 4 << 20}
# What an entry takes besides its key and value, about; text that is split at once.
_ENTRY, _STRETCH = 150, 8 << 20
# Latin letters whose lower case is one letter, then ASCII signs that are no letter, digit, apostrophe or control.
_PLAIN = "^(?P<word>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)(?P<rest>[!-&(-/:-@\\[-`{-~]*)$"
_GAP = re.compile(rb"[\x20\x09-\x0D]")
# How byte-level models write bytes as characters: printable ones as they are, all others from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_WRITTEN = {byte: 256 + k for k, byte in enumerate(b for b in range(256) if b not in _PRINTED)}
# What the tokenizer must do with a text for the rules above to hold.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# One of each for a worker: making them costs more than packing a short text.
_compressor, _decompressor = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
_encoders: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def splits_like_words(tokenizer) -> bool:
    """Whether a tokenizer treats texts as described above."""
    made = json.loads(tokenizer.to_str())
    parts = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])] == _NORMALIZERS
        and [p["type"] for p in parts] == ["Split", "ByteLevel"]
        and parts[0]["pattern"] == {"Regex": _PATTERN}
        and not parts[1]["add_prefix_space"]
        and not any(t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"]) or t["content"][0] != "<" for t in made["added_tokens"])
    )


class _Recent:
    """Ids by key, in two generations of half the bytes each."""

    def __init__(self, most: int):
        self.half, self.size, self.young, self.old = most // 2, 0, {}, {}

    def __setitem__(self, key, ids: bytes) -> None:
        self.size += len(key) + len(ids) + _ENTRY
        if self.size > self.half:
            self.size, self.young, self.old = len(key) + len(ids) + _ENTRY, {}, self.young
        self.young[key] = ids

    def of(self, keys: list, make: Callable[[list], Iterable[bytes]]) -> list[bytes]:
        """The ids of each key; ``make`` is given those that are not kept."""
        found = list(map(self.young.get, keys))
        old, missing = self.old, []
        for i, ids in enumerate(found):
            if ids is None:
                if (ids := old.get(keys[i])) is None:
                    missing.append(i)
                else:
                    found[i] = self[keys[i]] = ids
        for i, ids in zip(missing, make([keys[i] for i in missing]) if missing else ()):
            found[i] = self[keys[i]] = ids
        return found


class Encoder:
    """Texts in UTF-8 to little-endian ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.by_words, self.model = splits_like_words(self.tokenizer), self.tokenizer.model
        self.words, self.others = (_Recent(CACHED[kind]) for kind in ("words", "others"))

    @staticmethod
    def of(path: str) -> Encoder:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        return _encoders[path]

    def _bytes(self, ids: list[int]) -> bytes:
        out = array("H" if self.dtype.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        written = word if word.isascii() else word.encode().decode("latin-1").translate(_WRITTEN)
        return self._bytes([t.id for t in self.model.tokenize(written)])

    @staticmethod
    def _looked_up(keys: pa.Array, kept: _Recent, make: Callable[[list], Iterable[bytes]]) -> pa.Array:
        """Ids of each key, null for null."""
        coded = keys.dictionary_encode()
        return pa.array(kept.of(coded.dictionary.to_pylist(), make), pa.large_binary()).take(coded.indices)

    def _joined(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts that together are not long."""
        chunked = pc.ascii_split_whitespace(texts)
        coded = chunked.flatten().dictionary_encode()
        chunks = coded.dictionary
        plain = pc.extract_regex(chunks, _PLAIN)
        words = self._looked_up(pc.utf8_lower(pc.struct_field(plain, "word")), self.words, lambda new: map(self._word, new))
        rest = pc.if_else(plain.is_valid(), pc.struct_field(plain, "rest"), chunks)
        rest = self._looked_up(rest, self.others, self._whole)
        nothing = pa.scalar(b"", pa.large_binary())
        strung = pc.binary_join_element_wise(pc.fill_null(words, nothing), rest, nothing).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(strung).to_numpy())])
        bounds = ends[np.concatenate([[0], np.cumsum(chunked.value_lengths().to_numpy())])].tolist()
        data = memoryview(strung.buffers()[2] or b"")
        return [data[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def encoded(self, texts: pa.Array, end_id: int = END_ID) -> Iterator[bytes]:
        """Ids of each text and the end id."""
        end = self._bytes([end_id])
        if not self.by_words:
            yield from (ids + end for text in texts for ids in self._whole([text.as_py()]))
            return
        sizes = pc.binary_length(texts).to_numpy()
        first = 0
        while first < len(texts):
            last, size = first + 1, int(sizes[first])
            while last < len(texts) and size + sizes[last] <= _STRETCH:
                last, size = last + 1, size + int(sizes[last])
            if size <= _STRETCH:
                yield from (ids + end for ids in self._joined(texts.slice(first, last - first)))
            else:  # a long text by itself, in stretches that end at white space
                text, at, parts = texts[first].as_py().encode(), 0, []
                while at < len(text):
                    gap = _GAP.search(text, at + _STRETCH)
                    upto = gap.start() if gap else len(text)
                    parts += self._joined(pa.array([text[at:upto].decode()]))
                    at = upto
                yield b"".join(parts) + end
            first = last

    def encode(self, texts: list[bytes], end_id: int = END_ID) -> list[bytes]:
        return list(self.encoded(pa.array([text.decode() for text in texts], pa.string()), end_id))


def packed(ids: bytes) -> bytes:
    return _compressor.compress(ids)


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(_decompressor.decompress(data), dtype)


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID, source: str | None = None) -> DataFrame:
    """doc_id, n_tokens (with the end id), dtype, and ids: packed little-endian ids of the whole text.

    With a column ``source``, also its value, the partition, and how many ids of that source the partition has before.
    """
    named = docs.select("doc_id", *([F.col(source).cast("string").alias("source")] if source else []), text_of().alias("__llm_text"))
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, dtype string, ids binary"

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, so_far = Encoder.of(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            first, counts, ids, size = 0, [], [], 0
            for x in encoder.encoded(batch.column("__llm_text"), end_id):
                counts.append(len(x) // encoder.dtype.itemsize)
                ids.append(packed(x))
                size += len(ids[-1])
                if size > _STRETCH or first + len(ids) == batch.num_rows:
                    rows = batch.slice(first, len(ids))
                    columns = {"doc_id": rows.column("doc_id"), "n_tokens": pa.array(counts, pa.int64())}
                    columns |= {"dtype": pa.array([encoder.dtype.str] * len(ids), pa.string()), "ids": pa.array(ids, pa.binary())}
                    if source:
                        before = []
                        for name, n in zip(rows.column("source").to_pylist(), counts):
                            before.append(so_far.get(name, 0))
                            so_far[name] = before[-1] + n
                        columns |= {"source": rows.column("source"), "part": pa.array([part] * len(ids), pa.int64()), "before": pa.array(before, pa.int64())}
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                    first, counts, ids, size = first + len(ids), [], [], 0
        pa.default_memory_pool().release_unused()  # the worker lives on

    return named.mapInArrow(encode, f"{kinds}, source string, part bigint, before bigint" if source else kinds)
