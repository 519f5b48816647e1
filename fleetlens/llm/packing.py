"""Packing along a space-filling curve.

Hashed document vectors are projected to few dimensions; documents are range-sorted by their place on the Hilbert curve
through that space, so neighbours in a sequence resemble each other, and are laid end to end into sequences of ``length``
tokens, cut wherever a sequence is full. Only the last sequence of each range is not full; it is padded to a power of two.

The key ends with bits of a hash of the document key, so a group of equal texts, which share one place on the curve,
spreads over as many ranges as its size asks for. Range edges come from a bounded sample (``SAMPLE_ROWS``), as in any
range partitioner: they set how even the ranges are, not what is packed. Texts are shuffled once.

Defined cases: null and empty texts are one end token; repeated rows are packed each; rows with a null key are packed too;
other columns are ignored, whatever their names; an empty table gives no piece.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.labelled import row_sums
from fleetlens.llm.words import FOLD, SEGMENT, name_runs, row_chunks, space_words, text_column, word_names

TOKENIZER = "word_bpe_49k.json"
END = 2
LENGTH = 4096
DIMENSIONS, BITS = 4, 8
TIE_BITS = 24
SAMPLE_ROWS = 20_000
# Text of one range at least; ranges are as many as shuffle partitions beyond that.
RANGE_BYTES = 1 << 21
CACHE_PIECES = 600_000
# Characters from which a text is encoded in parts.
LONG = 1 << 17
_CLASSES = space_words()


# Hilbert order


def hilbert(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits a dimension (rows: points), by turning and mirroring the
    cells from the coarsest bit down, then undoing the Gray code."""
    x = [coordinates[:, d].astype(np.uint64) for d in range(coordinates.shape[1])]
    for bit in range(bits - 1, 0, -1):
        high, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for d in range(len(x)):
            on = (x[d] & high) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    flip = np.zeros(len(coordinates), np.uint64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(bit)) & np.uint64(1), np.uint64((1 << bit) - 1), np.uint64(0))
    x = [column ^ flip for column in x]
    key = np.zeros(len(coordinates), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for column in x:
            key = (key << np.uint64(1)) | ((column >> np.uint64(bit)) & np.uint64(1))
    return key


def curve_keys(texts: pa.Array) -> np.ndarray:
    """Hilbert keys of the projected word counts: every word adds or subtracts one in each dimension, by its name."""
    names, counts = word_names(texts, _CLASSES, FOLD)
    edges = np.concatenate([[0], np.cumsum(counts)])
    cells = np.empty((len(counts), DIMENSIONS), np.int64)
    for d in range(DIMENSIONS):
        signs = ((names >> np.uint64(7 + d)) & np.uint64(1)).astype(np.float64) * 2 - 1
        place = row_sums(signs, edges) / np.sqrt(np.maximum(counts, 1))
        cells[:, d] = (1 << BITS) * (0.5 + np.arctan(place / 2) / np.pi)
    return hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS).astype(np.int64)


# Tokens


_WHITE, _LETTER, _SIGN, _NUMBER = range(4)
# Characters of one or two bytes below this are split and folded here, all others by the library.
_CODES = 0x300
_TWO_BYTES = 0xC0
# White space of the tokenizer's own splitting rule.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0"


def _kind_of(code: int) -> int:
    if chr(code) in _SPACES:
        return _WHITE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(code))[0], _SIGN)


_KINDS = np.array([_kind_of(code) for code in range(_CODES)], np.uint8)
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else _CODES for c in range(_CODES)])
_STAYS = _LOWER < _CODES
_FIRST_FOREIGN = 0xC0 | (_CODES >> 6)
_BREAK = re.compile(r"[ \n]")


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes, the same as the library's; pieces are remembered.

    The tokenizer splits texts into runs of letters, single digits and runs of signs, and encodes these pieces one by one.
    Texts of characters below U+0300 without apostrophes (contractions) or special strings are split with numpy; new
    pieces are encoded together by the library, and told apart by the kind of token that ends a word. Any other text goes
    to the library whole.
    """

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        ends = np.zeros(self.library.get_vocab_size(), bool)
        for token, number in self.library.get_vocab(with_added_tokens=False).items():
            ends[number] = token.endswith("</w>")
        self.ends = ends
        self.quick = name == TOKENIZER
        self.known: dict[int, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: dict[int, str]) -> None:
        names = list(pieces)
        for begin in range(0, len(names), 1000):
            some = names[begin:begin + 1000]
            text = " ".join([pieces[name] for name in some])
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):
                self.known.update((name, self.whole(pieces[name])) for name in some)
                continue
            at = 0
            for name, stop in zip(some, stops.tolist(), strict=True):
                self.known[name] = ids[at:stop].tobytes()
                at = stop

    def _split(self, data: np.ndarray, starts: np.ndarray):
        """Pieces of texts laid end to end, and which texts the library has to do. Lowers ``data`` in place."""
        kind = _KINDS[data]
        sizes = np.diff(np.append(starts, len(data)))
        odd = (data == ord("'")) | (data >= _FIRST_FOREIGN)
        odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        upper = (data >= 65) & (data <= 90)
        data[upper] += 32
        two = np.flatnonzero((data >= _TWO_BYTES) & (data < _FIRST_FOREIGN))
        codes = ((data[two].astype(np.int64) & 0x1F) << 6) | (data[two + 1] & 0x3F)
        odd[two] |= ~_STAYS[codes]
        kind[two] = kind[two + 1] = _KINDS[codes]
        low = np.where(_STAYS[codes], _LOWER[codes], codes)
        data[two], data[two + 1] = 0xC0 | (low >> 6), 0x80 | (low & 0x3F)
        digits = np.flatnonzero((kind == _NUMBER) & ((data < 0x80) | (data >= _TWO_BYTES)))
        bad = np.add.reduceat(odd, starts, dtype=np.int64) > 0 if len(starts) else np.zeros(0, bool)
        kind[np.repeat(bad, sizes)] = _WHITE
        return *name_runs(data, kind, np.concatenate([starts, digits])), bad

    def _encode_some(self, texts: list[str], data: bytes, sizes: np.ndarray) -> list[bytes]:
        """Texts of at least one byte each, SEGMENT bytes in all."""
        data = np.frombuffer(bytearray(data), np.uint8)
        starts = np.cumsum(sizes) - sizes
        names, at, ends, bad = self._split(data, starts)
        distinct, first, inverse = np.unique(names, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        found = list(map(self.known.get, keys))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known = {}
        self._learn({keys[i]: data[at[first[i]]:ends[first[i]]].tobytes().decode() for i in new})
        for i in new:
            found[i] = self.known[keys[i]]
        pool = np.frombuffer(b"".join(found), "<u4")
        counts = np.array([len(ids) for ids in found], np.int64) // 4
        offsets = np.cumsum(counts) - counts
        each = counts[inverse]
        stops = np.cumsum(each)
        ids = pool[np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(offsets[inverse] - (stops - each), each)]
        edges = np.concatenate([[0], stops])[np.searchsorted(at, np.append(starts, len(data)))].tolist()
        return [self.whole(text) if odd else ids[edges[i]:edges[i + 1]].tobytes()
                for i, (text, odd) in enumerate(zip(texts, bad.tolist(), strict=True))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Long texts are done in parts that end before white space, which no token can hold."""
        if not self.quick:
            return [self.whole(text) for text in texts]
        parts, owner = [], []
        for i, text in enumerate(texts):
            begin = 0
            while len(text) - begin > LONG:
                cut = _BREAK.search(text, begin + LONG)
                if not cut:
                    break
                parts.append(text[begin:cut.start()])
                owner.append(i)
                begin = cut.start()
            parts.append(text[begin:])
            owner.append(i)
        done: list[list[bytes]] = [[] for _ in texts]
        group: list[int] = []
        data, size = [], 0

        def flush() -> None:
            nonlocal size
            if group:
                sizes = np.array([len(d) for d in data], np.int64)
                for i, ids in zip(group, self._encode_some([parts[i] for i in group], b"".join(data), sizes), strict=True):
                    done[owner[i]].append(ids)
            group.clear()
            data.clear()
            size = 0

        for i, part in enumerate(parts):
            raw = part.encode()
            if size + len(raw) > SEGMENT:
                flush()
            if len(raw) > SEGMENT:
                done[owner[i]].append(self.whole(part))
            elif raw:
                group.append(i)
                data.append(raw)
                size += len(raw)
        flush()
        return [b"".join(ids) for ids in done]


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(name)


# Packing


def _keyed(docs: DataFrame, text: str, key: str, edges: np.ndarray) -> DataFrame:
    """Rows with their key on the curve, and the range it falls into."""
    # Rows may share key and text, so the place of the row where it is read has a part in the tie.
    tie = F.shiftrightunsigned(F.xxhash64(F.col(key), F.monotonically_increasing_id()), 64 - TIE_BITS)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), tie.alias("tie"))

    def keyed(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                texts = text_column(part.column(1))
                place = (curve_keys(texts) << TIE_BITS) + part.column(2).to_numpy()
                ranges = np.searchsorted(edges, place, "right").astype(np.int32)
                yield pa.record_batch([part.column(0), texts, pa.array(place), pa.array(ranges)],
                                      names=["doc_id", "text", "place", "range"])

    return rows.mapInArrow(keyed, "doc_id long, text string, place long, range int")


def _range_edges(docs: DataFrame, text: str, key: str) -> np.ndarray:
    """Edges that part the sampled bytes evenly."""
    count = docs.count()
    share = min(1.0, SAMPLE_ROWS / max(count, 1))
    sample = docs if share == 1.0 else docs.sample(share, seed=11)
    rows = _keyed(sample, text, key, np.zeros(0, np.int64))
    found = rows.select("place", F.octet_length("text").alias("size")).toPandas().sort_values("place")
    sizes = found["size"].to_numpy(np.float64) + 1
    most = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = int(min(most, max(1, sizes.sum() / share // RANGE_BYTES)))
    at = np.searchsorted(np.cumsum(sizes), sizes.sum() * np.arange(1, ranges) / ranges)
    return found["place"].to_numpy(np.int64)[at]


PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def _pieces(rows: Iterator[pa.RecordBatch], length: int, tokenizer: str):
    sequence = offset = 0
    now = None
    for batch in rows:
        for part in row_chunks(batch, "text"):
            out = []
            ranges = part.column(2).to_pylist()
            data = encoder(tokenizer).encode(part.column(1).to_pylist())
            for key, of, ids in zip(part.column(0).to_pylist(), ranges, data, strict=True):
                if of != now:
                    now, sequence, offset = of, of << 32, 0
                ids += END.to_bytes(4, "little")
                total, start = len(ids) // 4, 0
                while start < total:
                    size = min(length - offset, total - start)
                    out.append((key, start, size, ids[4 * start:4 * (start + size)], total, sequence, offset))
                    start += size
                    offset += size
                    if offset == length:
                        sequence, offset = sequence + 1, 0
            columns = [pa.array(column, pa.binary() if k == 3 else pa.int64()) for k, column in enumerate(zip(*out, strict=True))]
            yield pa.record_batch(columns, names=[c.split()[0] for c in PIECES.split(", ")])


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH,
         tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: its document, the place and number of its tokens there, the ``ids`` as little-endian 32-bit
    numbers, and its sequence and place in it. Token ``offset + i`` of the sequence is id ``i`` of the piece."""
    edges = _range_edges(docs, text, key)
    ranged = _keyed(docs, text, key, edges).repartitionById(len(edges) + 1, F.col("range"))
    ordered = ranged.sortWithinPartitions("range", "place", "doc_id", "text").select("doc_id", "text", "range")
    return ordered.mapInArrow(lambda rows: _pieces(rows, length, tokenizer), PIECES)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
