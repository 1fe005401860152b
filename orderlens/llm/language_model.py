"""A bigram language model in a log-frequency Bloom filter.

Counts are quantised on a logarithmic scale. A token or pair of level q is put into
the filter once for every level up to q, and its level is read back by probing level
after level until one is missing. The upper levels, as many as a bounded size holds, are
broadcast. The whole filter, with every level, lies in parts by ranges of the keys; what
the broadcast levels do not tell is sent to the part that does. So no n-gram is left out
at any size of the corpus, and what a worker holds stays bounded.

p(w | h) = max(c(hw) - D, 0) / c(h) + g(h) * p(w), with counts from the filter; g is
what the discounted pairs leave, taken over all histories of the level of h. p(w) is
the additive unigram estimate. A history that never occurred leaves p(w) alone.

Counting goes through the cluster in parts, ranges of 62-bit hashes: a task sends each
part the sorted distinct hashes of its documents as Golomb-coded gaps with counts.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderlens.llm.common import crc_remainder, saved, table
from orderlens.llm.exact_dedup import golomb_decode, golomb_encode

BASE = 1.5
LEVELS = 64
DISCOUNT = 0.75
PROBES = 4
BITS_PER_ENTRY = 12
#: Bounds in bytes of the levels that are broadcast, whatever the corpus.
TOKEN_FILTER_BYTES = 16 << 20
PAIR_FILTER_BYTES = 8 << 20
#: At most this many of the most frequent tokens are broadcast with their exact counts.
HEAD_TOKENS = 1 << 19
#: Bytes of text per part of the counts.
PART_BYTES = 16 << 20
#: A part that is asked more than this is copied, and the questions are dealt out.
ASKED = 1 << 21
#: The list of such parts is broadcast up to this number of them, joined by a shuffle beyond.
COPIED_PARTS = 1 << 18
TOKEN_WIDTH, PAIR_WIDTH = 62, 54
_LEVEL_BITS = 6
_CHUNK_BYTES = 3 << 19
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * _M2
    return (x ^ (x >> np.uint64(27))) * _M1


END = xxh64_intdigest(b"\n") >> 2  # no word holds a line break
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_LOW_BYTES = np.array([2 ** (8 * n) - 1 for n in range(9)], np.uint64)
_LONG = 64


def _word_hashes(data, first, end):
    """Hashes of the words data[first:end], eight bytes at a time; of long ones by XXH64. Data goes on for 8 bytes."""
    eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    size = end - first
    out = size.astype(np.uint64) * _M1
    left, at = np.arange(len(first)), first
    while len(left):
        here = eights[at] & _LOW_BYTES[np.minimum(end[left] - at, 8)]
        out[left] = _mix(out[left] ^ here)
        more = (end[left] - at > 8) & (at - first[left] < _LONG)
        left, at = left[more], at[more] + 8
    for word in np.flatnonzero(size > _LONG):
        out[word] = xxh64_intdigest(data[first[word] : end[word]])
    return out >> np.uint64(2)


def token_hashes(texts):
    """Hashes of the lower-cased words of texts given as bytes, with the end after each; where the texts start."""
    data = b" ".join([*texts, b" " * 8]).lower()
    space = _SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    first, end = edges[0::2], edges[1::2]
    begins = np.cumsum([0, *[len(text) + 1 for text in texts]])
    before = np.searchsorted(first, begins)
    ends = before[1:] + np.arange(len(texts))
    tokens, word = np.empty(len(first) + len(texts), np.uint64), np.ones(len(first) + len(texts), bool)
    word[ends] = False
    tokens[ends], tokens[word] = END, _word_hashes(data, first, end)
    return tokens, np.concatenate([[0], ends[:-1] + 1])


def pair_key(history, tokens):
    return _mix(history * _M1 ^ tokens) >> np.uint64(16)


def pair_keys(tokens, starts):
    """Histories and keys of (history, token); the history of a first word is the end."""
    history = np.empty_like(tokens)
    history[1:] = tokens[:-1]
    history[starts] = END
    return history, pair_key(history, tokens)


def levels_of(counts):
    return (1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9)).astype(np.int64)


def _level_values():
    values = [0.0]
    for q in range(1, LEVELS):
        low, high = np.ceil(BASE ** (q - 1) - 1e-9), max(np.ceil(BASE ** (q - 1) - 1e-9), np.ceil(BASE**q - 1e-9) - 1)
        values.append((low + high) / 2)
    return np.array(values)


LEVEL_VALUES = _level_values()


def part_of(keys, width, parts):
    return ((keys >> np.uint64(width - 32)) * np.uint64(parts)) >> np.uint64(32)


# --- counting ---------------------------------------------------------------------

_SLICE = "part int, n int, k int, low long, unary binary, rest binary, ones binary, more binary"


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _pack(values, counts):
    """n, k, low, unary, rest, ones, more of sorted keys and their counts."""
    k, unary, rest = golomb_encode((values - values[0]).astype(np.int64))
    return len(values), k, int(values[0]), unary, rest, np.packbits(counts == 1).tobytes(), counts[counts > 1].astype(np.int64).tobytes()


def _unpack(n, k, low, unary, rest, ones, more):
    counts = np.ones(n, np.int64)
    counts[np.unpackbits(np.frombuffer(ones, np.uint8))[:n] == 0] = np.frombuffer(more, np.int64)
    return golomb_decode(n, k, unary, rest).astype(np.uint64) + np.uint64(low), counts


def _slices(keys, width, parts):
    """One row per part that some keys reach."""
    values, counts = np.unique(keys, return_counts=True)
    part = part_of(values, width, parts)
    rows = []
    for number in np.unique(part):
        a, b = np.searchsorted(part, [number, number + np.uint64(1)])
        rows.append((int(number), *_pack(values[a:b], counts[a:b])))
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(list(zip(*rows)) or [()] * 8, kinds)], _names(_SLICE))


def _in_chunks(batches, column="text"):
    """(rows of a batch, token hashes, starts of their texts), about _CHUNK_BYTES of text at a time."""
    for batch in batches:
        texts, size, first = [], 0, 0
        cells = batch.column(column)
        for row in range(batch.num_rows):
            texts.append(cells[row].as_py())
            size += len(texts[-1])
            if size >= _CHUNK_BYTES or row == batch.num_rows - 1:
                yield batch.slice(first, row + 1 - first), *token_hashes(texts)
                texts, size, first = [], 0, row + 1


def _sent(keys_of, width, parts, at_least=1 << 21):
    """Slices of the keys of about two million tokens at a time."""

    def run(batches):
        held, size = [], 0
        for _, tokens, starts in _in_chunks(batches):
            held.append(keys_of(tokens, starts))
            size += len(tokens)
            if size >= at_least:
                yield _slices(np.concatenate(held), width, parts)
                held, size = [], 0
        if size:
            yield _slices(np.concatenate(held), width, parts)

    return run


_KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
_ZSTD = {"codec": "zstd"}


def _padded(batch, schema):
    """A batch with all columns of a schema, null where it has none."""
    columns = [c.split() for c in schema.split(", ")]
    arrays = [batch.column(n) if n in batch.schema.names else pa.nulls(batch.num_rows, _KINDS[k]) for n, k in columns]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in columns])


def _planes(values):
    """Bytes of numbers, the lowest of all first, compressed; nothing for no numbers."""
    if not len(values):
        return b""
    return pa.compress(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes(), asbytes=True, **_ZSTD)


def _from_planes(data, n, kind, width=1):
    if not data:
        return np.zeros(0, kind) if width == 1 else np.zeros((0, width), kind)
    size = np.dtype(kind).itemsize * width
    values = np.frombuffer(pa.decompress(data, n * size, **_ZSTD), np.uint8).reshape(size, n).T.copy().view(kind)
    return values[:, 0] if width == 1 else values


_QUESTION = "part int, n int, low long, keys binary, first long, rows binary, others binary, levels binary"


def _questions(keys, width, parts, rows, others, levels):
    """A row for every part that the keys reach: its keys in order, what comes with each beside them.

    rows, others (hashes) and levels (of history and token) may be empty.
    """
    order = np.argsort(keys)
    keys, rows, others, levels = (x[order] if len(x) else x for x in (keys, rows, others, levels))
    numbers, begins = np.unique(part_of(keys, width, parts), return_index=True)
    out = []
    for number, a, b in zip(numbers, begins, [*begins[1:], len(keys)]):
        first = int(rows[a:b].min(initial=np.iinfo(np.int64).max)) if len(rows) else 0
        gaps, places = np.diff(keys[a:b], prepend=keys[a]), rows[a:b] - first
        out.append((int(number), int(b - a), int(keys[a]), _planes(gaps), first, _planes(places), _planes(others[a:b]), _planes(levels[a:b])))
    names = _names(_QUESTION)
    kinds = [_KINDS[c.split()[1]] for c in _QUESTION.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(list(zip(*out)) or [()] * len(names), kinds)], names)


def _read(asked):
    """keys, rows, others and levels of questions, one after the other."""
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, 2), np.int8))]
    for q in asked.select(_names(_QUESTION)).to_pylist():
        n = q["n"]
        keys = np.cumsum(_from_planes(q["keys"], n, np.uint64)) + np.uint64(q["low"])
        rows = _from_planes(q["rows"], n, np.int64) + q["first"]
        found.append((keys, rows, _from_planes(q["others"], n, np.uint64), _from_planes(q["levels"], n, np.int8, 2)))
    return [np.concatenate(x) for x in zip(*found)]


_NO_ROWS, _NO_HASHES, _NO_LEVELS = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, 2), np.int8)
_PAIRS_SENT = _SLICE + ", keys binary, first long, rows binary, others binary, levels binary"


def _sent_pairs(tokens_filter, parts, at_least=1 << 21):
    """Slices of pairs with their history's level; pairs of other histories, for the part that knows them."""

    def flush(closed, histories, tokens):
        yield _padded(_slices(np.concatenate(closed), PAIR_WIDTH, parts), _PAIRS_SENT)
        asked = _questions(np.concatenate(histories), TOKEN_WIDTH, parts, _NO_ROWS, np.concatenate(tokens), _NO_LEVELS)
        yield _padded(asked, _PAIRS_SENT)

    def run(batches):
        held = tokens_filter.value
        closed, histories, others, size = [], [], [], 0
        for _, tokens, starts in _in_chunks(batches):
            history, keys = pair_keys(tokens, starts)
            seen, where = np.unique(history, return_inverse=True)
            level = held.levels(seen)[where]
            known = (level > 0) | (held.least == 1)
            closed.append(keys[known] << np.uint64(_LEVEL_BITS) | level[known].astype(np.uint64))
            histories.append(history[~known])
            others.append(tokens[~known])
            size += len(tokens)
            if size >= at_least:
                yield from flush(closed, histories, others)
                closed, histories, others, size = [], [], [], 0
        if size:
            yield from flush(closed, histories, others)

    return run


def _counts(counted, tokens):
    """Exact counts of tokens of one part."""
    n = np.zeros(len(tokens), np.int64)
    for held in counted.select(_names(_SLICE)[1:]).to_pylist():
        keys, counts = _unpack(*held.values())
        at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
        n = np.where(keys[at] == tokens, counts[at], n)
    return n


def _levels_told(counted, tokens):
    """Levels of tokens of one part, 0 for those that do not occur."""
    return np.where((n := _counts(counted, tokens)) > 0, levels_of(np.maximum(n, 1)), 0)


def _with_level(parts):
    """Slices of the pairs whose history's level a part of the tokens tells; a copy may be asked nothing."""

    def run(asked, counted):
        history, _, tokens, _ = _read(asked)
        level = _levels_told(counted, history).astype(np.uint64)
        return pa.Table.from_batches([_slices(pair_key(history, tokens) << np.uint64(_LEVEL_BITS) | level, PAIR_WIDTH, parts)])

    return run


def _asked(questions, held, answer, schema):
    """Answers of the parts of ``held`` to the questions that are addressed to them.

    A part that is asked much is copied, so that no task gets more than about ASKED
    questions, however often one key is asked for.
    """
    loads = questions.groupBy("part").agg(F.ceil(F.sum("n") / ASKED).cast("long").alias("copies")).where("copies > 1")
    loads = saved(questions.sparkSession, loads)
    if loads.count() <= COPIED_PARTS:
        loads = F.broadcast(loads)
    dealt = questions.join(loads, "part", "left")
    dealt = dealt.withColumn("copy", F.pmod(F.xxhash64("keys", "rows"), F.coalesce("copies", F.lit(1).cast("long")))).drop("copies")
    number = F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1).cast("long")) - 1)
    copies = held.join(loads, "part", "left").select(*held.columns, F.explode(number).alias("copy"))
    return dealt.groupBy("part", "copy").cogroup(copies.groupBy("part", "copy")).applyInArrow(answer, schema)


_COUNTED = _SLICE + ", total long, stats array<long>"


def _merged(stats_of):
    """The slices of a part in one, with its total count and a table of statistics."""

    def run(slices):
        rows = slices.select(_names(_SLICE)[1:]).to_pylist()
        lists = [_unpack(*r.values()) for r in rows]
        keys, counts = (np.concatenate(x) for x in zip(*lists))
        del lists, rows
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        packed = _pack(keys, counts)
        columns = [[slices["part"][0].as_py()], *[[x] for x in packed], [int(counts.sum())], [stats_of(keys, counts).tolist()]]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.int64(), pa.list_(pa.int64())]
        return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], _names(_COUNTED))

    return run


def _token_stats(keys, counts):
    """Distinct tokens per level."""
    return np.bincount(levels_of(counts), minlength=LEVELS)


def _pair_stats(keys, counts):
    """Per level of the history and of the pair: distinct pairs, then their occurrences."""
    at = (keys & np.uint64(LEVELS - 1)).astype(np.int64) * LEVELS + levels_of(counts)
    return np.concatenate([np.bincount(at, minlength=LEVELS**2), np.bincount(at, counts, LEVELS**2).astype(np.int64)])


def _summed(counted, size):
    """The statistics of all parts together: a table of fixed size."""
    rows = counted.select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("n")).where("n > 0").collect()
    out = np.zeros(size, np.int64)
    for pos, n in rows:
        out[pos] = n
    return out


# --- the filter -------------------------------------------------------------------


class CountFilter:
    """Quantised counts by membership: parts of equal numbers of bits, side by side.

    Levels under ``least`` are not held.
    """

    def __init__(self, width, parts, bits, least, cells=None):
        self.width, self.parts, self.bits, self.least, self.cells = width, parts, bits, least, cells

    def _places(self, first, step, probe):
        mixed = (first + np.uint64(probe) * step) >> np.uint64(32)
        return ((mixed * np.uint64(self.bits)) >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def _steps(keys, level):
        first = _mix(keys + np.array([level], np.uint64) * _M1)
        return first, _mix(first ^ _M2) | np.uint64(1)

    def part(self, keys, counts):
        """The bits of one part."""
        cells = np.zeros(self.bits // 8, np.uint8)
        levels = levels_of(counts)
        for level in range(self.least, int(levels.max(initial=0)) + 1):
            steps = self._steps(keys[levels >= level], level)
            for probe in range(PROBES):
                place = self._places(*steps, probe)
                np.bitwise_or.at(cells, place >> 3, (1 << (place & 7)).astype(np.uint8))
        return cells

    def levels(self, keys):
        """Level of each key, 0 where it is not held."""
        out = np.zeros(len(keys), np.int64)
        base = part_of(keys, self.width, self.parts).astype(np.int64) * (self.bits // 8)
        left = np.arange(len(keys))
        for level in range(self.least, LEVELS):
            first, step = self._steps(keys, level)
            for probe in range(PROBES):
                place = self._places(first, step, probe)
                held = (self.cells[base + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 == 1
                keys, base, left, first, step = keys[held], base[held], left[held], first[held], step[held]
            if not len(left):
                break
            out[left] = level
        return out


def _least_level(per_level, most):
    """The smallest level from which on the entries of all levels are at most so many."""
    from_here = np.cumsum(per_level[::-1])[::-1]  # keys of this level or above
    entries = np.cumsum(from_here[::-1])[::-1]  # entries from this level on
    fits = np.flatnonzero(entries[1:] <= most)
    return int(fits[0]) + 1 if len(fits) else LEVELS - 1, entries


def filter_parts(spark, counted, width, keys_of):
    """The whole filter, all levels: the cells of every part, saved."""

    def run(batches):
        for batch in batches:
            cells = []
            for row in batch.select(_names(_SLICE)).to_pylist():
                keys, counts = _unpack(*[row[c] for c in _names(_SLICE)[1:]])
                bits = -(-int(levels_of(counts).sum()) * BITS_PER_ENTRY // 8) * 8 + 64
                cells.append(CountFilter(width, 1, bits, 1).part(keys_of(keys), counts).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(cells, pa.binary())], ["part", "cells"])

    return saved(spark, counted.select(_names(_SLICE)).mapInArrow(run, "part int, cells binary"))


def build_filter(counted, per_level, width, parts, most_bytes, keys_of=lambda keys: keys):
    """A CountFilter of the upper levels, ``most_bytes`` at most, from packed counts, a part at a time."""
    least, entries = _least_level(per_level, most_bytes * 8 // BITS_PER_ENTRY)
    bits = max(64, -(-int(entries[least]) * BITS_PER_ENTRY // parts // 8) * 8 + 8)
    bits = min(bits, max(64, most_bytes * 8 // parts // 8 * 8))
    empty = CountFilter(width, parts, bits, least)

    def run(batches):
        for batch in batches:
            rows = batch.select(_names(_SLICE)).to_pylist()
            cells = []
            for row in rows:
                keys, counts = _unpack(*[row[c] for c in _names(_SLICE)[1:]])
                cells.append(empty.part(keys_of(keys), counts).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(cells, pa.binary())], ["part", "cells"])

    # Together most_bytes at most.
    found = counted.select(_names(_SLICE)).mapInArrow(run, "part int, cells binary").toArrow()
    out = np.zeros(parts * (bits // 8), np.uint8)
    for part, cells in zip(found["part"].to_pylist(), found["cells"]):
        out[part * (bits // 8) : (part + 1) * (bits // 8)] = np.frombuffer(cells.as_buffer(), np.uint8)
    empty.cells = out
    return empty


def head_tokens(counted, per_level):
    """Hashes and exact counts of the tokens of the highest levels, at most HEAD_TOKENS."""
    above = np.cumsum(per_level[::-1])[::-1]
    fits = np.flatnonzero(above <= HEAD_TOKENS)
    least = max(1, int(fits[0]) if len(fits) else LEVELS)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _unpack(*[row[c] for c in _names(_SLICE)[1:]])
                top = levels_of(counts) >= least
                yield pa.RecordBatch.from_arrays([pa.array(keys[top].view(np.int64)), pa.array(counts[top])], ["key", "n"])

    found = counted.select(_names(_SLICE)).mapInArrow(run, "key long, n long").toArrow()
    keys, counts = found["key"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


# --- scoring ----------------------------------------------------------------------

_SCORED = (
    "doc_id long, held_out boolean, row long, n_tokens long, log_sum double, known long, score double, "
    "kind int, " + _QUESTION
)
#: What a part is asked: the count of a token; the level of a pair; of a history; of a token after a known history.
_COUNT, _PAIR, _HISTORY, _TOKEN = range(4)
_WIDTHS = {_COUNT: TOKEN_WIDTH, _PAIR: PAIR_WIDTH - _LEVEL_BITS, _HISTORY: TOKEN_WIDTH, _TOKEN: TOKEN_WIDTH}
#: Partial sums of up to 2**_BUCKET_BITS consecutive rows in one.
_ANSWER = "bucket long, rows binary, log_sums binary, knowns binary, scores binary"
_BUCKET_BITS = 10
_SUMS = "row long, rare_sum double, rare_known long, rare_score double"


class _Smoothing:
    """Probabilities from levels."""

    def __init__(self, total, distinct, rest):
        self.total, self.rest = total, rest
        self.divisor = total + 0.1 * (distinct + 1)

    def logs(self, history_level, token_level, pair_level):
        """log10 p of tokens after their histories."""
        alone = (LEVEL_VALUES[token_level] + 0.1) / self.divisor
        history = LEVEL_VALUES[history_level]
        pair = np.minimum(LEVEL_VALUES[pair_level], history)
        p = np.maximum(pair - DISCOUNT, 0) / np.maximum(history, 1) + self.rest[history_level] * alone
        return np.log10(np.minimum(p, 1.0))


class _Model:
    def __init__(self, smoothing, tokens, pairs, head):
        self.smoothing, self.tokens, self.pairs = smoothing, tokens, pairs
        self.head_keys, self.head_counts = head

    def score(self, tokens, starts):
        """Per text the log10 probability, the sum of log10(c + 0.1) and the number of known tokens.

        All as far as broadcast counts tell. Then, for other places, what is asked of
        the parts: (kind, places, keys, others, levels known of history and token).
        """
        words, where = np.unique(tokens, return_inverse=True)
        token_level = self.tokens.levels(words)[where]
        history_level = np.empty_like(token_level)
        history_level[1:] = token_level[:-1]
        history_level[starts] = self.tokens.levels(np.array([END], np.uint64))[0]
        history, keys = pair_keys(tokens, starts)
        pair_level = self.pairs.levels(keys)
        left, asked = np.ones(len(tokens), bool), []
        seen = (history_level > 0) & (token_level > 0)  # else there is no such pair
        for kind, filters, unknown, first, second in (
            (_HISTORY, self.tokens, history_level == 0, history, tokens),
            (_TOKEN, self.tokens, token_level == 0, tokens, keys),
            (_PAIR, self.pairs, seen & (pair_level == 0), keys, None),
        ):
            at = np.flatnonzero(left & unknown) if filters.least > 1 else _NO_ROWS
            left[at] = False
            levels = np.stack([history_level[at], token_level[at]], axis=1).astype(np.int8)
            asked.append((kind, at, first[at], _NO_HASHES if second is None else second[at], levels))
        logs, at = np.zeros(len(tokens)), np.flatnonzero(left)
        logs[at] = self.smoothing.logs(history_level[at], token_level[at], pair_level[at])

        place = np.minimum(np.searchsorted(self.head_keys, words), max(0, len(self.head_keys) - 1))
        held = self.head_keys[place] == words if len(self.head_keys) else np.zeros(len(words), bool)
        exact = np.zeros(len(words))
        exact[held] = np.log10(self.head_counts[place[held]] + 0.1)
        at = np.flatnonzero(~held[where])
        asked.append((_COUNT, at, tokens[at], _NO_HASHES, _NO_LEVELS))
        sums = [np.add.reduceat(x, starts) for x in (logs, exact[where], held[where].astype(np.int64))]
        return *sums, asked


def _scorer(model, parts, at_least=1 << 20):
    def sent(held):
        for kind, found in held.items():
            rows, keys, others, levels = (np.concatenate(x) for x in zip(*found))
            batch = _questions(keys, _WIDTHS[kind], parts, rows, others, levels)
            batch = batch.append_column("kind", pa.array([kind] * batch.num_rows, pa.int32()))
            yield _padded(batch, _SCORED)

    def run(batches):
        m = model.value
        held, size = {}, 0
        for rows, tokens, starts in _in_chunks(batches):
            ids = rows.column("row").to_numpy()
            sizes = np.diff(np.append(starts, len(tokens)))
            score, logs, known, asked = m.score(tokens, starts)
            own = [rows.column("doc_id"), rows.column("held_out"), *[pa.array(x) for x in (ids, sizes.astype(np.int64), logs, known, score)]]
            yield _padded(pa.RecordBatch.from_arrays(own, _names(_SCORED)[: len(own)]), _SCORED)
            row = np.repeat(ids, sizes)
            for kind, at, *found in asked:
                if len(at):
                    held.setdefault(kind, []).append((row[at], *found))
                    size += len(at)
            if size >= at_least:
                yield from sent(held)
                held, size = {}, 0
        yield from sent(held)

    return run


def _by_row(rows, *values):
    """The distinct rows and the sums of the values of each."""
    ids, at = np.unique(rows, return_inverse=True)
    return ids, *[np.bincount(at, x, len(ids)) if len(ids) else np.zeros(0) for x in values]


def _summed_by_row(rows, logs, known, score):
    sums = _by_row(rows, logs, known, score)
    numbers, begins = np.unique(sums[0] >> _BUCKET_BITS, return_index=True)
    ends = [*begins[1:], len(sums[0])]
    packed = [pa.array([x[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()) for x in sums]
    return pa.table([pa.array(numbers.astype(np.int64)), *packed], _names(_ANSWER))


def _added(answers):
    """The answers about some consecutive rows, added up."""
    kinds = (np.int64, np.float64, np.float64, np.float64)
    columns = [np.frombuffer(b"".join(answers[c].to_pylist()), kind) for c, kind in zip(_names(_ANSWER)[1:], kinds)]
    rows, logs, known, score = _by_row(*columns)
    return pa.table([pa.array(rows), pa.array(logs), pa.array(known.astype(np.int64)), pa.array(score)], _names(_SUMS))


def _tail(asked, counted):
    """Sums of log10(c + 0.1) and numbers of known tokens, per row, of one part's rare tokens."""
    tokens, rows, _, _ = _read(asked)
    n = _counts(counted, tokens)
    return _summed_by_row(rows, np.log10(n + 0.1), n > 0, np.zeros(len(n)))


def _history_told(parts):
    """Questions for the token, now that the history's level is known."""

    def run(asked, counted):
        history, rows, tokens, levels = _read(asked)
        levels[:, 0] = _levels_told(counted, history)
        return pa.Table.from_batches([_questions(tokens, TOKEN_WIDTH, parts, rows, pair_key(history, tokens), levels)])

    return run


def _token_told(parts):
    """Questions for the pair, now that the token's level is known too."""

    def run(asked, counted):
        tokens, rows, keys, levels = _read(asked)
        levels[:, 1] = _levels_told(counted, tokens)
        return pa.Table.from_batches([_questions(keys, _WIDTHS[_PAIR], parts, rows, _NO_HASHES, levels)])

    return run


def _pair_told(smoothing):
    """Sums of log10 p, per row, of the positions whose pair one part of the filter holds, if any does."""

    def run(asked, held):
        keys, rows, _, levels = _read(asked)
        levels = levels.astype(np.int64)
        pair = np.zeros(len(keys), np.int64)
        for cells in held["cells"]:
            cells = np.frombuffer(cells.as_py(), np.uint8)
            pair = CountFilter(_WIDTHS[_PAIR], 1, len(cells) * 8, 1, cells).levels(keys)
        nothing = np.zeros(len(keys))
        return _summed_by_row(rows, nothing, nothing, smoothing.logs(levels[:, 0], levels[:, 1], pair))

    return run


def held_out(id_column):
    return crc_remainder(id_column, 10) == 0


def scored(spark, docs, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null, empty and blank texts consist of the end token alone. Repeated rows are
    counted and scored one by one, with equal scores; rows without doc_id count as
    having an empty id. Without training documents the base score and the score are
    those of a uniform guess. An empty table gives an empty result. Tokens are told
    apart by 62-bit hashes. Other columns are not read.
    """
    sc = spark.sparkContext
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), text)
    training = rows.where(~F.col("held_out")).select("text")
    parts = 8 + (training.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES

    sent = training.mapInArrow(_sent(lambda tokens, starts: tokens, TOKEN_WIDTH, parts), _SLICE)
    tokens = saved(spark, sent.groupBy("part").applyInArrow(_merged(_token_stats), _COUNTED))
    per_level = _summed(tokens, LEVELS)
    total = tokens.agg(F.sum("total")).first()[0] or 0
    token_filter = build_filter(tokens, per_level, TOKEN_WIDTH, parts, TOKEN_FILTER_BYTES)
    token_cells = sc.broadcast(token_filter)

    sent = training.mapInArrow(_sent_pairs(token_cells, parts), _PAIRS_SENT)
    slices = _names(_SLICE)
    if token_filter.least > 1:
        sent = saved(spark, sent)
        rare = sent.where(F.col("keys").isNotNull()).select(_names(_QUESTION))
        sent = sent.where(F.col("keys").isNull()).select(slices).unionByName(_asked(rare, tokens.select(slices), _with_level(parts), _SLICE))
    pairs = saved(spark, sent.select(slices).groupBy("part").applyInArrow(_merged(_pair_stats), _COUNTED))
    distinct, occurrences = _summed(pairs, 2 * LEVELS**2).reshape(2, LEVELS, LEVELS)
    width, keys_of = PAIR_WIDTH - _LEVEL_BITS, lambda keys: keys >> np.uint64(_LEVEL_BITS)
    pair_filter = build_filter(pairs, distinct.sum(axis=0), width, parts, PAIR_FILTER_BYTES, keys_of)
    rest = np.where(occurrences.sum(axis=1) > 0, DISCOUNT * distinct.sum(axis=1) / np.maximum(occurrences.sum(axis=1), 1), 1.0)
    rest[0] = 1.0
    smoothing = _Smoothing(int(total), int(per_level.sum()), rest)
    model = _Model(smoothing, token_filter, pair_filter, head_tokens(tokens, per_level))
    held = sc.broadcast(model)

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    out = saved(spark, numbered.mapInArrow(_scorer(held, parts), _SCORED))

    def asked(kind):
        return out.where(F.col("kind") == kind).select(_names(_QUESTION))

    counts = tokens.select(slices)
    answers, about_pairs = _asked(asked(_COUNT), counts, _tail, _ANSWER), asked(_PAIR)
    if token_filter.least > 1:
        about_tokens = asked(_TOKEN).unionByName(_asked(asked(_HISTORY), counts, _history_told(parts), _QUESTION))
        told = _asked(saved(spark, about_tokens), counts, _token_told(parts), _QUESTION)
        about_pairs = saved(spark, about_pairs.unionByName(told))
    if max(token_filter.least, pair_filter.least) > 1:
        cells = filter_parts(spark, pairs, width, keys_of)
        answers = answers.unionByName(_asked(about_pairs, cells, _pair_told(smoothing), _ANSWER))
    rare = answers.groupBy("bucket").applyInArrow(_added, _SUMS)
    base = F.col("log_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(smoothing.divisor)))
    return out.where(F.col("kind").isNull()).join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(smoothing.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )


def op7_lm_scoring(spark, sf_dir):
    return scored(spark, table(spark, sf_dir, "documents"))
