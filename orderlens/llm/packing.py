"""Packing documents into training sequences with a bounded number of open windows.

Each partition of the input packs its documents as they come. What fills whole sequences
is cut off; the rest goes into the open window that it fits best. When it fits none and
``WINDOWS`` are open, the fullest is emitted, filled up with the beginning of the rest, so
that it needs no padding. What is open at the end, at most ``WINDOWS`` windows per
partition, is merged the same way over groups of ``FAN`` partitions, then of ``FAN``
groups, until one group is left. Its last ids are cut at powers of two.

A partition is read once and its pieces saved; a lost task packs the same documents in
the same order again. Memory holds a batch of texts and the open windows.
"""

import base64
import os
import struct
from functools import lru_cache, partial, reduce

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm.common import saved, table

LENGTH = 1024
WINDOWS = 16
#: Partitions, or groups of them, whose open windows are merged in one task.
FAN = 64
END_ID = 0
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

_END = struct.pack("<I", END_ID)
_WIDTH = len(_END)
_BATCH = 512


# --- ids --------------------------------------------------------------------------


class Ids:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    ``ranks`` is the same vocabulary as ``path``, as a file of ranks (base64 bytes and
    number per line), and ``pattern`` the way its tokenizer cuts a text before it merges:
    merging by ranks gives the same ids in a fifth of the time. Texts that hold a special
    token are encoded by the tokenizer itself, as are all texts where no ranks are given.
    """

    def __init__(self, path, ranks=None, pattern=None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = None
        if ranks:
            with open(ranks, "rb") as lines:
                known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={}).encode_ordinary

    def __call__(self, text):
        if self.merge is None or any(token in text for token in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.merge(text)
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def _ids(*files):
    """Read once per Python worker."""
    return Ids(*files)


# --- one partition ------------------------------------------------------------------


class Packer:
    """Open windows of one partition; a full one comes out as a list of pieces.

    A piece is (name, start, ids): ids of a document from its id number ``start`` on.
    """

    def __init__(self, length=LENGTH, windows=WINDOWS):
        self.length, self.most = length, windows
        self.windows = []  # [free ids, pieces]

    def add(self, name, start, ids):
        """Place a piece; yields the sequences that are full."""
        whole = self.length * _WIDTH
        while ids:
            size = len(ids) // _WIDTH
            if size >= self.length:
                yield [(name, start, ids[:whole])]
                start, ids = start + self.length, ids[whole:]
                continue
            fits = [w for w in self.windows if w[0] >= size]
            if fits:
                window = min(fits, key=lambda w: w[0])
            elif len(self.windows) < self.most:
                window = [self.length, []]
                self.windows.append(window)
            else:
                window, size = (w := min(self.windows, key=lambda w: w[0])), w[0]
            window[1].append((name, start, ids[: size * _WIDTH]))
            window[0] -= size
            if not window[0]:
                self.windows = [w for w in self.windows if w is not window]
                yield window[1]
            start, ids = start + size, ids[size * _WIDTH :]

    def closed(self):
        """All open windows as one row of ids, cut into full sequences and powers of two."""
        pieces = [piece for _, window in sorted(self.windows, key=lambda w: w[0]) for piece in window]
        left = sum(len(ids) for _, _, ids in pieces) // _WIDTH
        self.windows, sequence, room = [], [], 0
        for name, start, ids in pieces:
            while ids:
                if not room:
                    room = min(self.length, 1 << (left.bit_length() - 1))
                size = min(room, len(ids) // _WIDTH)
                sequence.append((name, start, ids[: size * _WIDTH]))
                start, ids, room, left = start + size, ids[size * _WIDTH :], room - size, left - size
                if not room:
                    yield sequence
                    sequence = []


# --- pieces as rows -------------------------------------------------------------------

_KIND = "row long, id {id}, start long, ids binary, doc_tokens long, sequence_id long, offset long, open int, part long"
_FIELDS = [c.split()[0] for c in _KIND.split(", ")]


def _types(id_type):
    kinds = {"{id}": id_type, "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return [kinds[c.split()[1]] for c in _KIND.split(", ")]


class _Rows:
    """Rows of the sequences and open windows of one part; sequences are numbered from ``first`` on."""

    def __init__(self, part, first, id_type):
        self.part, self.number, self.types, self.rows = part, first, _types(id_type), []

    def add(self, pieces, window=None):
        at = 0
        for (row, name, tokens), start, ids in pieces:
            sequence = self.number if window is None else None
            self.rows.append((row, name, start, ids, tokens, sequence, at, window, self.part))
            at += len(ids) // _WIDTH
        self.number += window is None

    def taken(self):
        columns = zip(*self.rows) if self.rows else [[] for _ in _FIELDS]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, self.types)], _FIELDS)


def _first_number(round_, part):
    """Sequences of a round and part are numbered from here, below 2**32 of each."""
    return (round_ << 56) | (part << 32)


def _packed(batches, ids_of, length, windows):
    """Pieces of the documents (row, id, text) of one partition, the open windows last."""
    part, packer, encode, rows = TaskContext.get().partitionId(), Packer(length, windows), _ids(*ids_of), None
    for batch in batches:
        rows = rows or _Rows(part, _first_number(0, part), batch.schema.field("id").type)
        for at in range(0, batch.num_rows, _BATCH):
            some = batch.slice(at, _BATCH)
            for row, name, text in zip(some.column("row").to_pylist(), some.column("id").to_pylist(), some.column("text")):
                ids = encode(text.as_py() or "") + _END
                for sequence in packer.add((row, name, len(ids) // _WIDTH), 0, ids):
                    rows.add(sequence)
            yield rows.taken()
    for number, (_, pieces) in enumerate(packer.windows):
        rows.add(pieces, number)
    if rows:
        yield rows.taken()


def _merged(key, group, round_, length, windows, last):
    """Open windows of up to ``FAN`` parts packed again, in order of parts."""
    (part,) = (k.as_py() for k in key)
    group = group.sort_by([("part", "ascending"), ("open", "ascending"), ("offset", "ascending")])
    rows, packer = _Rows(part, _first_number(round_, part), group.schema.field("id").type), Packer(length, windows)
    for row, name, start, ids, tokens in zip(*(group.column(c).to_pylist() for c in ("row", "id", "start", "ids", "doc_tokens"))):
        for sequence in packer.add((row, name, tokens), start, ids):
            rows.add(sequence)
    if last:
        for sequence in packer.closed():
            rows.add(sequence)
    for number, (_, pieces) in enumerate(packer.windows):
        rows.add(pieces, number)
    return pa.Table.from_batches([rows.taken()])


# --- the operator ---------------------------------------------------------------------


def pack(spark, docs, vocabulary, ranks=None, pattern=None, id_col="doc_id", text_col="text", length=LENGTH, windows=WINDOWS, fan=FAN):
    """Pieces of all documents: row, the id, start, ids, doc_tokens, sequence_id, offset.

    ``vocabulary`` is the path of a tokenizer file, which every executor has; ``ranks`` and
    ``pattern`` are those of ``Ids``. A document is its ids, then id 0. ids holds a piece's ids as unsigned
    little-endian 32-bit numbers; start is how many ids of the document come before it;
    offset its place in its sequence. row tells the rows of ``docs`` apart. Every id lies
    in exactly one piece. Every sequence has ``length`` ids but the last few, whose
    lengths are powers of two; so none needs padding.

    Null and empty texts are id 0 alone. Repeated rows, and rows that share an id or have
    none, are documents of their own. Very long texts are encoded whole and cut into as many
    sequences as they fill. An empty table gives an empty result. Other columns are not
    read. The result hangs on how the input is dealt into partitions; the same partitions
    give the same result.
    """
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = _KIND.format(id=docs.schema[id_col].dataType.simpleString())
    packed = partial(_packed, ids_of=(vocabulary, ranks, pattern), length=length, windows=windows)
    rounds = [saved(spark, named.mapInArrow(packed, kind), compression="zstd")]
    while True:
        left = rounds[-1].where("open IS NOT NULL")
        most = left.agg(F.max("part")).first()[0]
        if most is None:
            break
        merge = partial(_merged, round_=len(rounds), length=length, windows=windows, last=most < fan)
        group = F.floor(F.col("part") / fan).cast("long").alias("group")
        rounds.append(saved(spark, left.groupBy(group).applyInArrow(merge, kind)))
    pieces = reduce(DataFrame.unionByName, [r.where("open IS NULL") for r in rounds])
    return pieces.drop("open", "part").withColumnRenamed("id", id_col)


def op12_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 1024 ids."""
    files = public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    pieces = pack(spark, table(spark, sf_dir, "documents"), *files)
    return pieces.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / _WIDTH).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
