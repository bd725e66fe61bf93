"""Quality classifier: a sparse rule ensemble.

Boosted trees of little depth are grown over statistics of labelled texts; every path from a root
to a node is a rule (a conjunction of thresholds). A logistic model with an L1 penalty gives most
rules no weight; the others are compiled into one Spark column expression over the statistics.

The fit takes at most MAX_LABELLED labelled texts (those of smallest id hash) to the driver;
scoring covers every row. Inputs of a score are statistics of the text only.

Results for odd input: null and empty texts have statistics of 0 and a score like any other; rows
whose id is null or repeated are scored one by one; labels that are null don't count; without any
label every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, slices, table
from .words import NOT_SPACE, buffers, run_hashes, spans

STATS = ["n_bytes", "n_words", "word_bytes", "upper", "digits", "symbols", "bars", "bangs", "stops", "line_bytes", "distinct", "doubled", "top_word"]
MAX_LABELLED, THRESHOLD = 20_000, 0.3
SLICE_BYTES = 2 << 20


def _marks(chars: str) -> np.ndarray:
    lut = np.zeros(256, np.int8)
    lut[[ord(c) for c in chars]] = 1
    return lut


CLASSES = {
    "upper": _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _marks("0123456789"), "symbols": _marks("#$%&*+<=>@[]\\^_`{}~"),
    "bars": _marks("|"), "bangs": _marks("!"), "stops": _marks(".,;:?"),
}


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATS for each text: sizes in bytes, shares of bytes, and shares of words that
    are distinct, equal to the word before, or the text's most frequent word."""
    data, starts = buffers(texts)
    n = np.diff(starts).astype(float)
    out = np.zeros((len(n), len(STATS)))
    total = np.zeros(len(data) + 1, np.int64)

    def sums(flags: np.ndarray) -> np.ndarray:
        np.cumsum(flags, out=total[1:])
        return (total[starts[1:]] - total[starts[:-1]]).astype(float)

    first, end, of_text = spans(data, starts, NOT_SPACE)
    words = np.diff(of_text)
    some = np.maximum(words, 1)
    col = {name: out[:, i] for i, name in enumerate(STATS)}
    col["n_bytes"][:], col["n_words"][:] = n, words
    length = np.concatenate([[0], np.cumsum(end - first)])
    col["word_bytes"][:] = (length[of_text[1:]] - length[of_text[:-1]]) / some
    for name, lut in CLASSES.items():
        col[name][:] = sums(lut[data]) / np.maximum(n, 1)
    col["line_bytes"][:] = n / (1 + sums(data == 10))
    if len(first):
        text = np.repeat(np.arange(len(n)), words)
        hashes = run_hashes(data, first, end)
        same = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
        col["doubled"][:] = np.bincount(text[1:][same], minlength=len(n)) / some
        bits = np.uint64(max(1, len(n)).bit_length())
        keys = np.sort(text.astype(np.uint64) << (np.uint64(64) - bits) | hashes >> bits)
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        runs, owner = np.diff(np.append(new, len(keys))), (keys[new] >> (np.uint64(64) - bits)).astype(np.int64)
        col["distinct"][:] = np.bincount(owner, minlength=len(n)) / some
        top = np.zeros(len(n))
        np.maximum.at(top, owner, runs)
        col["top_word"][:] = top / some
    return out


def text_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep and STATS of every row; no name of keep may be one of STATS."""
    fields = [docs.schema[c] for c in keep]
    names = [*keep, *(() if text_col in keep else (text_col,))]
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [statistics(part) for part in slices(batch.column(at), SLICE_BYTES)]
            got = np.concatenate(done) if done else np.zeros((0, len(STATS)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(got[:, i].copy()) for i in range(len(STATS)))], [*keep, *STATS])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"{s} double" for s in STATS)])
    return docs.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(lean(run), schema)


@dataclass
class Rule:
    """Conjunction of (statistic, is_above, threshold), with its weight."""

    terms: list[tuple[str, bool, float]]
    weight: float = 0.0


@dataclass
class RuleModel:
    bias: float
    rules: list[Rule]

    def column(self) -> Column:
        """The score as one Spark expression over the statistics."""
        z = F.lit(self.bias)
        for r in self.rules:
            hit = F.lit(True)
            for name, above, t in r.terms:
                hit = hit & (F.col(name) > t if above else F.col(name) <= t)
            z = z + F.when(hit, r.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def _grow(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, path: tuple, paths: list, out: np.ndarray, n_bins: int) -> None:
    """One regression tree: adds the path of each node below the root, and its leaf values to out."""
    g, h = grad[rows], hess[rows]
    value = g.sum() / (h.sum() + 1.0)
    best = (1e-6, None)
    if depth and len(rows) >= 20:
        base = g.sum() ** 2 / (h.sum() + 1.0)
        for f in range(bins.shape[1]):
            sg = np.cumsum(np.bincount(bins[rows, f], g, n_bins))[:-1]
            sh = np.cumsum(np.bincount(bins[rows, f], h, n_bins))[:-1]
            sn = np.cumsum(np.bincount(bins[rows, f], minlength=n_bins))[:-1]
            gain = sg**2 / (sh + 1.0) + (g.sum() - sg) ** 2 / (h.sum() - sh + 1.0) - base
            gain[(sn < 5) | (sn > len(rows) - 5)] = 0
            b = int(gain.argmax())
            if gain[b] > best[0]:
                best = (gain[b], (f, b))
    if best[1] is None:
        out[rows] += value
        return
    f, b = best[1]
    above = bins[rows, f] > b
    for side in (False, True):
        longer = (*path, (f, side, b))
        paths.append(longer)
        _grow(bins, grad, hess, rows[above == side], depth - 1, longer, paths, out, n_bins)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, penalty: float = 0.001, n_bins: int = 48, steps: int = 400) -> RuleModel:
    """A rule model for labels y (0 or 1) of rows x of STATS."""
    if not len(y):
        return RuleModel(0.0, [])
    mean = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return RuleModel(prior, [])
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    z, paths = np.full(len(y), prior), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        step = np.zeros(len(y))
        _grow(bins, y - p, p * (1 - p), np.arange(len(y)), depth, (), paths, step, n_bins)
        z += rate * step
    paths = list(dict.fromkeys(paths))
    hits = np.ones((len(y), len(paths)), np.float32)
    for j, path in enumerate(paths):
        for f, above, b in path:
            hits[:, j] *= (bins[:, f] > b) == above
    centre, scale = hits.mean(0), np.maximum(hits.std(0), 0.02)
    hits -= centre
    hits /= scale
    # accelerated proximal gradient steps for the L1 penalty
    w = v = np.zeros(len(paths))
    bias = vb = prior
    rate, t = 4.0 / max(np.linalg.norm(hits[:2000], 2) ** 2 / min(len(y), 2000), 1e-9) / 2, 1.0
    for _ in range(steps):
        r = y - 1 / (1 + np.exp(-(hits @ v + vb)))
        w_new = v + rate * (hits.T @ r) / len(y)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - rate * penalty, 0)
        b_new, t_new = vb + rate * r.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - bias)
        w, bias, t = w_new, b_new, t_new
    used = np.flatnonzero(w)
    rules = [Rule([(STATS[f], above, float(cuts[f][b])) for f, above, b in paths[j]], float(w[j] / scale[j])) for j in used]
    return RuleModel(float(bias - (w * centre / scale).sum()), rules)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled(docs: DataFrame, labels: DataFrame, target: str = "quality", limit: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most limit labelled rows that aren't held out."""
    some = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    some = some.select("doc_id", F.col(target).cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "y").limit(limit)
    rows = text_statistics(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id"), keep=("doc_id", "y"))
    rows = rows.orderBy("doc_id", "y", *STATS).limit(2 * limit).toPandas()
    return rows[STATS].to_numpy(float).reshape(-1, len(STATS)), rows["y"].to_numpy(float)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows and columns of docs, with score (probability of label 1) and predicted in place of
    columns of these names."""
    names = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    model = fit(*labelled(docs, labels))
    # own columns go by place, so that none has a statistic's name
    kept = [f"kept_{i}" for i in range(len(names))]
    at = next(i for i, c in enumerate(names) if c.lower() == "text")
    wide = text_statistics(docs.select(*(docs[c].alias(k) for c, k in zip(names, kept))), kept[at], tuple(kept))
    out = wide.select(*(F.col(k).alias(c) for c, k in zip(names, kept)), model.column().alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the rows of predicted quality 0. Null texts stay null and are scored as empty ones;
    repeated rows get one score; further columns, whatever their names, come along."""
    kept = [f"kept_{i}" for i in range(len(docs.columns))]
    rows = docs.select(*(docs[c].alias(k) for c, k in zip(docs.columns, kept)), docs["doc_id"], docs["text"])
    model = fit(*labelled(rows, table(spark, sf_dir, "labels")))
    at = kept[[c.lower() for c in docs.columns].index("text")]
    wide = text_statistics(rows, at, tuple(kept))
    return wide.where(model.column() >= THRESHOLD).select(*(F.col(k).alias(c) for c, k in zip(docs.columns, kept)))
