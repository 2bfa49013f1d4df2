"""Sum-of-squares online packing of tokenised documents into fixed windows.

Documents are tokenised as a whole and cut into full windows and one
remainder.  A packer takes remainders in the order of a hash and keeps, in an
array by fill level, the number of partially filled windows; each remainder
goes to the level (or a new window) that makes the sum of the squared counts
smallest, the fullest one among ties.  Packers work on disjoint, hash-dealt
shares of a bounded number of pieces, so the waste of each is that of a few
open windows.

Results on unusual input: a null or empty text is the end token alone; each
repeated row is packed as a document of its own; a null ``doc_id`` is kept as
null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

WINDOW = 4096
END = 2
#: Pieces for each packer.
SHARE = 8192
#: Entries that a tokeniser's caches may hold; a full cache is emptied.
CACHE = 250_000

#: Words as the vocabulary's own splitter finds them in lower-case text of ASCII and Latin-1 letters.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^a-z0-9À-ÖØ-öø-ÿ]+")
#: Text that no normaliser changes but for its case; anything else goes through the tokeniser itself.
_PLAIN = re.compile(r"(?!.*<\|)[\x21-\x7eÀ-ÖØ-öø-ÿ]*\Z")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in for each byte in byte-level vocabularies: itself where printable, else from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTokenizer(dict):
    """Maps a chunk without white space to its ids, packed as little-endian unsigned 32-bit numbers.

    White space never joins tokens in this vocabulary, so the ids of a text are
    those of its chunks.  Chunks and words are cached.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() else "".join(self.letters[b] for b in word.encode())
        ids = [t.id for t in self.model.tokenize(shown)]
        if len(self.words) >= CACHE:
            self.words.clear()
        out = self.words[word] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def __missing__(self, chunk: str) -> bytes:
        if _PLAIN.match(chunk):
            out = b"".join(self.words.get(w) or self._word(w) for w in _WORDS.findall(chunk.lower()))
        else:
            ids = self.full.encode(chunk, add_special_tokens=False).ids
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[chunk] = out
        return out

    def ids(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" ")))


_loaded: dict[str, WordTokenizer] = {}


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Rows of doc_id, start, length, ids_crc32, doc_tokens: each document's full windows and its remainder."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _loaded.get(tokenizer) or _loaded.setdefault(tokenizer, WordTokenizer(tokenizer))
        last = struct.pack("<I", end)
        for b in it:
            row, start, length, crc, total = [], [], [], [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                ids = encode.ids(text) + last
                n = len(ids) // 4
                view = memoryview(ids)
                for at in range(0, n, window):
                    row.append(k)
                    start.append(at)
                    length.append(min(window, n - at))
                    crc.append(zlib.crc32(view[4 * at : 4 * (at + window)]))
                    total.append(n)
            own = b.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([own, *(pa.array(x, pa.int64()) for x in (start, length, crc, total))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    schema = docs.select("doc_id").schema
    for name in ("start", "length", "ids_crc32", "doc_tokens"):
        schema = schema.add(name, "long")
    return docs.select("doc_id", "text").mapInArrow(batches, schema)


def sum_of_squares(lengths: list[int], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The window and the offset in it of each piece, placed one after the other."""
    counts = np.zeros(window + 1, np.int64)
    levels: list[list[int]] = [[] for _ in range(window + 1)]
    places, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for k, n in enumerate(lengths):
        if n >= window:
            places[k], offsets[k] = made, 0
            made += 1
            continue
        open_ = counts[1 : window - n + 1]
        change = 2 * (counts[1 + n :] - open_) + 2
        change[-1] -= 2 * counts[window] + 1  # a full window is no longer counted
        change[open_ == 0] = np.iinfo(np.int64).max
        best = len(change) - 1 - int(np.argmin(change[::-1])) if len(change) else -1
        if best >= 0 and change[best] <= 2 * counts[n] + 1:
            level = best + 1
            at = levels[level].pop()
            counts[level] -= 1
        else:
            level, at = 0, made
            made += 1
        places[k], offsets[k] = at, level
        if level + n < window:
            levels[level + n].append(at)
            counts[level + n] += 1
    return places, offsets


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, share: int = SHARE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of each piece."""
    cut = materialize(pieces(docs, tokenizer, window, end).withColumn("piece", F.monotonically_increasing_id()))
    packers = max(1, -(-cut.count() // share))

    def place(share: pa.Table) -> pa.Table:
        share = share.sort_by([("turn", "ascending"), ("piece", "ascending")])
        places, offsets = sum_of_squares(share["length"].to_pylist(), window)
        sequence = (share["packer"].to_numpy().astype(np.int64) << 32) + places
        return share.select(names).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    dealt = cut.withColumn("turn", F.xxhash64("piece")).withColumn("packer", F.pmod("turn", F.lit(packers)).cast("int"))
    schema = cut.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("packer").applyInArrow(place, schema)
