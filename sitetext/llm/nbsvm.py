"""Quality classifier: a linear support vector machine on naive Bayes features.

A text is the set of its n-grams: words and word pairs, and runs of up to three word shapes, where
a shape tells letters, capitals, digits, marks, and whether a word repeats the one before. Each
n-gram's indicator is scaled by its log-count ratio, the log of how much likelier a document of
one class is to have it than one of the other. On these features dual coordinate descent fits a
linear model with hinge loss, which is then pulled towards the plain naive Bayes weights. A
logistic curve fitted on rows that the descent did not see turns margins into scores.

The ratios count every labelled training document. The descent uses a bounded sample of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitetext.llm import texts

#: Features, by hash.
DIMENSIONS = 1 << 18
#: Most labelled rows that dual coordinate descent sees; every fifth of them fits the curve only.
SAMPLE_ROWS = 8_000
THRESHOLD = 0.3
#: Smoothing of counts, weight of the loss, passes, and share of the fitted weights in the mix.
ALPHA, PENALTY, PASSES, MIX = 1.0, 1.0, 15, 0.75

_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[97:123] = 97
_SHAPES[65:91] = 65
_SHAPES[48:58] = 48
_SHAPES[128:] = 97
_IN_RUNS = np.zeros(256, bool)
_IN_RUNS[[97, 65, 48]] = True


def _shape_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words with runs of letters, capitals and digits shortened to one."""
    shapes = _SHAPES[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (shapes[1:] != shapes[:-1]) | ~_IN_RUNS[shapes[1:]]
    keep[starts] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return texts.span_hashes(shapes[keep], before[starts], before[ends])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every distinct feature of each row, sorted by row."""
    n_rows = len(offsets) - 1
    starts, ends, rows = texts.word_spans(data, offsets)
    words = texts.span_hashes(texts.lowered(data), starts, ends)
    shapes = _shape_hashes(data, starts, ends)
    with np.errstate(over="ignore"):
        same = np.r_[False, (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])][: len(words)]
        shapes = texts.mixed(shapes + same.astype(np.uint64))
        streams = []
        for kind, (base, width) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
            size = max(0, len(base) - width + 1)
            key = np.full(size, kind + 1, np.uint64)
            for i in range(width):
                key = texts.mixed(key * np.uint64(0x9FB21C651E98DF25) + base[i : i + size])
            whole = rows[:size] == rows[width - 1 : width - 1 + size]
            streams.append(
                rows[:size][whole] * DIMENSIONS
                + (key[whole] % np.uint64(DIMENSIONS)).astype(np.int64)
            )
    seen = np.unique(np.concatenate(streams)) if n_rows else np.zeros(0, np.int64)
    return seen // DIMENSIONS, seen % DIMENSIONS


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have each feature, in blocks of features, summed per task."""
    counts, size = np.zeros((2, DIMENSIONS), np.int64), [0, 0]
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for first, end, data, offsets in texts.pieces(batch.column(0)):
            rows, found = features(data, offsets)
            for label in (0, 1):
                of = labels[first:end] == label
                counts[label] += np.bincount(found[of[rows]], minlength=DIMENSIONS)
                size[label] += int(of.sum())
    if sum(size):
        block = DIMENSIONS // 16
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(range(16), pa.int32()),
                "counts": [counts[:, i * block : (i + 1) * block].tobytes() for i in range(16)],
                "sizes": pa.array([size] * 16, pa.list_(pa.int64())),
            }
        )


def _added(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of one block of counts over all tasks, taken batch by batch."""
    total, sizes, block = 0, np.zeros(2, np.int64), 0
    for batch in group:
        block = batch.column(0)[0].as_py()
        for counts, size in zip(batch.column(1), batch.column(2)):
            total = total + np.frombuffer(counts.as_py(), np.int64)
            sizes += size.as_py()
    yield pa.RecordBatch.from_pydict(
        {
            "block": pa.array([block], pa.int32()),
            "counts": [total.tobytes()],
            "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
        }
    )


def log_count_ratios(labelled: DataFrame) -> np.ndarray:
    """The ratio of each feature, from (text, label) rows; its size is DIMENSIONS."""
    ddl = "block int, counts binary, sizes array<bigint>"
    blocks = texts.map_batches(labelled, _counted, ddl).groupBy("block").applyInArrow(_added, ddl)
    counts, sizes = np.zeros((2, DIMENSIONS)), np.zeros(2)
    width = DIMENSIONS // 16
    for row in blocks.collect():
        at = row["block"] * width
        counts[:, at : at + width] = np.frombuffer(row["counts"], np.int64).reshape(2, width)
        sizes = np.array(row["sizes"], float)
    p = (counts[1] + ALPHA) / (sizes[1] + 2 * ALPHA)
    q = (counts[0] + ALPHA) / (sizes[0] + 2 * ALPHA)
    return np.log(p / q).astype(np.float32)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, n: int, penalty: float, passes: int
) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model; rows hold the columns of their values."""
    w, bias = np.zeros(n, np.float32), 0.0
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(7)
    square = np.array([float(v @ v) + 1.0 for v in values])
    for _ in range(passes):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i], values[i]
            slope = y[i] * (float(w[at] @ v) + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), penalty)
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[at] += np.float32(step) * v
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w, bias


def logistic_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve that turns margins into probabilities, by Newton's method."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    theta, x = np.array([1.0, 0.0]), np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (p - target) + 1e-6 * theta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def _scaled(ratios: np.ndarray, found: np.ndarray) -> np.ndarray:
    v = ratios[found]
    return v / max(float(np.sqrt(v @ v)), 1e-6)


def _fit(ratios_sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, rows, labels, ids = ratios_sent.value, [], [], []
        for batch in batches:
            labels += batch.column(1).to_pylist()
            ids += batch.column(2).to_pylist()
            for first, end, data, offsets in texts.pieces(batch.column(0)):
                of, found = features(data, offsets)
                borders = np.searchsorted(of, np.arange(end - first + 1))
                rows += [found[a:b] for a, b in zip(borders[:-1], borders[1:])]
        order = sorted(range(len(rows)), key=lambda i: (ids[i] * 2654435761 % 2**32, ids[i]))
        rows, labels = [rows[i] for i in order], [labels[i] for i in order]
        y = np.where(np.array(labels, float) > 0, 1.0, -1.0)
        values = [_scaled(ratios, r) for r in rows]
        for_curve = np.arange(len(rows)) % 5 == 0
        fit = np.flatnonzero(~for_curve)
        w, bias = dual_coordinate_descent(
            [rows[i] for i in fit], [values[i] for i in fit], y[fit], DIMENSIONS, PENALTY, PASSES
        )
        mean = float(np.abs(w).sum() / max(1, np.count_nonzero(w)))
        w = MIX * w + (1 - MIX) * mean
        margins = np.array([float(w[r] @ v) + bias for r, v in zip(rows, values)])
        held = for_curve if for_curve.any() else np.ones(len(rows), bool)
        slope, offset = logistic_curve(margins[held], y[held]) if len(rows) else (1.0, 0.0)
        yield pa.RecordBatch.from_pydict(
            {
                "weights": [w.astype(np.float32).tobytes()],
                "bias": [float(bias)],
                "slope": [slope],
                "offset": [offset],
            }
        )

    return run


def _scored(model_sent):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, weights, bias, slope, offset = model_sent.value
        weighted, squared = (ratios * weights).astype(np.float64), ratios.astype(np.float64) ** 2
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in texts.pieces(batch.column(1)):
                n = end - first
                rows, found = features(data, offsets)
                length = np.sqrt(np.bincount(rows, weights=squared[found], minlength=n))
                margin = np.bincount(rows, weights=weighted[found], minlength=n)
                margin = margin / np.maximum(length, 1e-6) + bias
                score = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
                yield texts.pack({"doc_id": ids.slice(first, n), "score": score}, schema)

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, held_out, score from 0 to 1, and predicted.

    Documents whose crc32 of the doc_id as text is divisible by 5 are held out: their labels are
    not read. `labels` has one row per doc_id; of several, the smallest label counts, and null
    labels count for nothing. Only texts are inputs of a score. A null or empty text has no
    n-grams and gets the score of the bias alone. With no labelled rows, or none of one class, all
    scores are equal. Rows are independent: repeated rows get equal scores, a null id stays null
    and is not held out, an empty table gives none, and other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    known = (
        labels.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"CAST(`{label_col}` AS INT) AS label")
        .where("label IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 5 <> 0")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    # Labels grow with the documents: the join is the same at every size.
    labelled = source.join(known.hint("merge"), "doc_id")
    ratios = spark.sparkContext.broadcast(log_count_ratios(labelled.select("text", "label")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = source.join(F.broadcast(chosen), "doc_id").select("text", "label", "doc_id")
    fitted = texts.map_batches(
        sample.repartition(1),
        _fit(ratios),
        "weights binary, bias double, slope double, offset double",
    ).first()
    if fitted is None:
        fitted = {"weights": bytes(4 * DIMENSIONS), "bias": 0.0, "slope": 1.0, "offset": 0.0}
    weights = np.frombuffer(fitted["weights"], np.float32)
    model = spark.sparkContext.broadcast(
        (ratios.value, weights, fitted["bias"], fitted["slope"], fitted["offset"])
    )
    scored = texts.map_batches(source, _scored(model), "doc_id bigint, score double")
    return scored.selectExpr(
        "doc_id",
        "coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, false) AS held_out",
        "score",
        f"CAST(score >= {threshold} AS INT) AS predicted",
    )
