"""Operator 9: packing documents into sequences by length patterns.

Only the histogram of piece lengths reaches the driver, bounded by the
sequence length, and one count for each window of WINDOW_ROWS pieces. There, patterns of a
few lengths that fill a sequence exactly are enumerated, repeat counts are
fitted to the histogram by non-negative least squares and rounded down, and
what is left is packed best fit, longest first, whole groups of equal bins at
a time. The plan comes back as intervals of ranks within a length, so each
piece finds its sequence and offset from its rank alone.

Null or empty text: one piece that holds the end id. Repeated rows are each
packed. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folia.llm import vocabulary
from folia.llm.common import slices, text_buffers, written
from folia.llm.word_bpe import word_ids

#: Pieces of one length that are numbered in one window; a length that a third of all pieces have is split over as many hash buckets as that makes.
WINDOW_ROWS = 20_000
#: Patterns fitted at most, and rounds of the fit.
MOST_PATTERNS, ROUNDS = 30_000, 12
#: Bytes of text encoded at once.
SLICE_BYTES = 1 << 20


def patterns(lengths: np.ndarray, capacity: int, most: int = MOST_PATTERNS) -> np.ndarray:
    """Rows of three lengths, 0 for none, that are present and fill a sequence: all pairs, and triples on a stride that keeps to `most`."""
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    small = lengths[lengths < capacity]
    pairs = small[(small >= capacity - small) & present[capacity - small]]
    out = [np.column_stack([pairs, capacity - pairs, np.zeros_like(pairs)])]
    stride = max(1, round(len(small) ** 2 / (6 * most)))
    a, b = np.meshgrid(small, small, indexing="ij")
    c = capacity - a - b
    fits = (a >= b) & (b >= c) & (c > 0) & (np.add.outer(np.arange(len(small)), 3 * np.arange(len(small))) % stride == 0)
    fits[fits] = present[c[fits]]
    out.append(np.column_stack([a[fits], b[fits], c[fits]]))
    return np.concatenate(out)


def fitted(rows: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - histogram|, by coordinate descent; column j of A counts pattern j's lengths."""
    left = histogram.astype(float).tolist()
    columns = []
    for row in rows.tolist():
        times: dict[int, int] = {}
        for length in row:
            if length:
                times[length] = times.get(length, 0) + 1
        columns.append((list(times.items()), sum(t * t for t in times.values())))
    x = [0.0] * len(columns)
    for _ in range(rounds):
        moved = 0.0
        for j, (times, norm) in enumerate(columns):
            new = max(0.0, x[j] + sum(left[n] * t for n, t in times) / norm)
            if (step := new - x[j]) != 0.0:
                x[j] = new
                for n, t in times:
                    left[n] -= step * t
                moved += abs(step)
        if moved < 0.001 * max(1.0, sum(x)):
            break
    return np.array(x)


def best_fit(histogram: np.ndarray, capacity: int) -> dict[tuple, int]:
    """Bins by content, longest pieces first, each into the fullest bin that takes it; bins of equal content are one group."""
    groups: dict[int, dict[tuple, int]] = defaultdict(dict)  # by free space
    spaces: list[int] = []

    def put(space: int, content: tuple, n: int) -> None:
        if content not in groups[space] and not groups[space]:
            bisect.insort(spaces, space)
        groups[space][content] = groups[space].get(content, 0) + n

    for length in range(capacity, 0, -1):
        count = int(histogram[length])
        while count:
            k = bisect.bisect_left(spaces, length)
            if k == len(spaces):
                each = capacity // length
                full, rest = divmod(count, each)
                if full:
                    put(capacity - each * length, ((length, each),), full)
                if rest:
                    put(capacity - rest * length, ((length, rest),), 1)
                break
            space = spaces[k]
            content, n = next(iter(groups[space].items()))
            each = min(space // length, max(1, count // n))
            used = min(n, count // each)
            del groups[space][content]
            if n > used:
                groups[space][content] = n - used
            if not groups[space]:
                spaces.pop(k)
            put(space - each * length, (*content, (length, each)), used)
            count -= used * each
    out: dict[tuple, int] = defaultdict(int)
    for by_content in groups.values():
        for content, n in by_content.items():
            out[content] += n
    return out


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Sequences as (content, repeats), content being (length, times) pairs. The fitted counts are scaled by a few factors before rounding; the plan with the fewest sequences stands."""
    lengths = np.flatnonzero(histogram)
    best = None
    rows = patterns(lengths, capacity) if len(lengths) else np.zeros((0, 3), int)
    x = fitted(rows, histogram) if len(rows) else np.zeros(0)
    for scale in (1.0, 0.9, 0.6, 0.3):
        left, fixed = histogram.astype(np.int64).copy(), {}
        for row, n in zip(rows.tolist(), np.floor(x * scale).astype(int).tolist(), strict=True):
            content: dict[int, int] = {}
            for length in row:
                if length:
                    content[length] = content.get(length, 0) + 1
            n = min([n, *(int(left[k]) // t for k, t in content.items())])
            if n > 0:
                fixed[tuple(content.items())] = n
                for k, t in content.items():
                    left[k] -= n * t
        bins = dict(fixed)
        for content, n in best_fit(left, capacity).items():
            bins[content] = bins.get(content, 0) + n
        if best is None or sum(bins.values()) < sum(best.values()):
            best = bins
    return sorted(best.items(), reverse=True)


def intervals(bins: list[tuple[tuple, int]]) -> np.ndarray:
    """For each length, intervals of ranks: length, first rank, first sequence, offset, pieces of this length a sequence."""
    taken: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for content, n in bins:
        offset = 0
        for length, times in content:
            out.append((length, taken[length], sequence, offset, times))
            taken[length] += n * times
            offset += length * times
        sequence += n
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, id_column: str, text_column: str, file: str, end_id: int, capacity: int) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of at most `capacity`."""
    docs = docs.select(id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        coder = word_ids(file)
        try:
            for batch in batches:
                rows, piece, start, length, crc = [], [], [], [], []
                _, offsets = text_buffers(batch.column(1))
                for i, j in slices(offsets, SLICE_BYTES):
                    for row, ids in enumerate(coder.packed([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]), i):
                        view = memoryview(ids + end)
                        for k in range(0, len(view), 4 * capacity):
                            part = view[k : k + 4 * capacity]
                            rows.append(row)
                            piece.append(k // (4 * capacity))
                            start.append(k // 4)
                            length.append(len(part) // 4)
                            crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], schema=pa.schema([batch.schema.field(0), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32"))]))
        finally:
            coder.forget()

    return docs.mapInArrow(run, f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", file: str | None = None, end_id: int = 0, capacity: int = 2048, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """A row for each piece: its place in its document, its sequence and its offset there."""
    file = file or vocabulary.path(vocabulary.WORD_BPE)
    cut = written(pieces(docs, id_column, text_column, file, end_id, capacity), "pieces")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most a row for each length
        histogram[length] = n
    buckets = -(-histogram // window_rows)  # of each length
    start = np.cumsum(buckets) - buckets
    of_length = lambda values: F.get(F.array(*[F.lit(int(v)) for v in values]), F.col("length").cast("int"))
    bucket = of_length(start) + F.pmod(F.xxhash64(id_column, "piece", "ids_crc32"), of_length(np.maximum(buckets, 1)))
    cut = cut.withColumn("_bucket", bucket.cast("long"))
    counts = np.zeros(int(buckets.sum()), np.int64)
    for at, n in cut.groupBy("_bucket").count().collect():  # a row for each window of window_rows pieces, and at most one more for each length
        counts[at] = n
    whole = np.concatenate([[0], np.cumsum(counts)])
    before = whole[:-1] - np.repeat(whole[start], buckets)
    found = intervals(plan(histogram, capacity))
    keys = found[:, 0] << 40 | found[:, 1]
    within = Window.partitionBy("_bucket").orderBy(id_column, "piece", "start", "ids_crc32")
    ranked = cut.withColumn("_rank", F.row_number().over(within).cast("long") - 1)
    schema = cut.drop("_bucket").schema

    def place(batches):
        for batch in batches:
            length, at, rank = (batch.column(n).to_numpy() for n in ("length", "_bucket", "_rank"))
            rank = rank + before[at]
            _, first, sequence, offset, times = found[np.searchsorted(keys, length << 40 | rank, "right") - 1].T
            rank = rank - first
            own = pa.RecordBatch.from_arrays([batch.column(f.name) for f in schema.fields] + [pa.array(sequence + rank // times), pa.array(offset + rank % times * length)], names=[f.name for f in schema.fields] + ["sequence_id", "offset"])
            yield own

    return ranked.mapInArrow(place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ", sequence_id long, offset long")
