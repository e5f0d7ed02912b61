"""Quality by a sparse rule ensemble: tree paths as rules, lasso logistic weights, Spark columns.

Statistics of the whole text are DataFrame expressions. On labelled rows, boosted shallow trees are
grown on the driver; every path from a root is a conjunctive rule. A logistic model with an L1 penalty
weighs the rules, the penalty being the sparsest whose loss on a fifth of the rows is near the best.
The rules that keep a weight are compiled into one column expression, so scoring is a projection.

At most ``FIT_ROWS`` labelled rows, the first by md5 of their id, are fitted; only their statistics
reach the driver. Every document is scored over its whole text.

Defined results: a null text counts as empty, and empty texts have statistics 0; rows without a label
are never learnt from; of labels that contradict, 1 holds; a null id is never held out; with one class
alone or fewer than 20 labelled rows, the score is the share of label 1 (0.5 without any). Repeated rows
are scored each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import SPACES, WORD, saved

FIT_ROWS = 20_000
TREES = 16
DEPTH = 3
THRESHOLD = 0.3


def statistics() -> dict[str, Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    chars, words = F.length(text).cast("double"), count(WORD)
    per = lambda x, n: x / F.greatest(n, F.lit(1.0))
    pieces = F.split(text, SPACES)
    lines = F.split(text, "\n")
    return {
        "words": words,
        "word_chars": per(chars, words),
        "upper": per(count(r"\p{Lu}"), chars),
        "symbols": per(count(r"[#$%&*|!<>{}\[\]=_~^@]"), chars),
        "stops": per(count(r"[.,;:?]"), words),
        "digits": per(count(r"[0-9]"), chars),
        "distinct_words": per(F.size(F.array_distinct(pieces)).cast("double"), words),
        "line_words": per(words, F.size(lines).cast("double")),
        "distinct_lines": per(F.size(F.array_distinct(lines)).cast("double"), F.size(lines).cast("double")),
    }


NAMES = ["words", "word_chars", "upper", "symbols", "stops", "digits", "distinct_words", "line_words", "distinct_lines"]

#: (feature index, whether above, threshold)
Test = tuple[int, bool, float]


def grow(x: np.ndarray, rest: np.ndarray, cuts: list[np.ndarray], depth: int) -> tuple[list[tuple[Test, ...]], np.ndarray]:
    """Paths of a regression tree on rest, and its values."""
    value = np.full(len(x), rest.mean() if len(rest) else 0.0)
    if depth == 0 or len(x) < 20:
        return [], value
    best, split = 1e-9, None
    total, n = rest.sum(), len(rest)
    for f, at in enumerate(cuts):
        if not len(at):
            continue
        place = np.searchsorted(at, x[:, f], side="left")  # x <= at[k] for place <= k
        sums, sizes = np.cumsum(np.bincount(place, rest, len(at) + 1))[:-1], np.cumsum(np.bincount(place, minlength=len(at) + 1))[:-1]
        ok = (sizes >= 5) & (n - sizes >= 5)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, sums**2 / sizes + (total - sums) ** 2 / (n - sizes) - total**2 / n, 0)
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, split = gain[k], (f, float(at[k]))
    if split is None:
        return [], value
    paths = []
    f, cut = split
    for above in (False, True):
        side = (x[:, f] > cut) == above
        below, value[side] = grow(x[side], rest[side], cuts, depth - 1)
        test = (f, above, cut)
        paths += [(test,), *[(test, *p) for p in below]]
    return paths, value


def tidy(path: tuple[Test, ...]) -> tuple[Test, ...]:
    """The same conjunction with one test a side of a feature."""
    bounds: dict[tuple[int, bool], float] = {}
    for f, above, cut in path:
        key = (f, above)
        bounds[key] = (max if above else min)(bounds.get(key, cut), cut)
    return tuple(sorted((f, above, cut) for (f, above), cut in bounds.items()))


def holds(x: np.ndarray, path: tuple[Test, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, cut in path:
        out &= (x[:, f] > cut) == above
    return out


def rules(x: np.ndarray, y: np.ndarray) -> list[tuple[Test, ...]]:
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1])) for f in range(x.shape[1])]
    found: dict[tuple[Test, ...], None] = {}
    raw, rng = np.zeros(len(y)), np.random.default_rng(0)
    for _ in range(TREES):
        pick = rng.random(len(y)) < 0.7
        p = 1 / (1 + np.exp(-raw))
        paths, _ = grow(x[pick], (y - p)[pick], cuts, DEPTH)
        for path in paths:
            found[tidy(path)] = None
        for path in [q for q in paths if not any(len(o) > len(q) and o[: len(q)] == q for o in paths)]:
            at = holds(x, path)
            h = (p[at] * (1 - p[at])).sum()
            raw[at] += 0.5 * float(np.clip((y - p)[at].sum() / (h + 1.0), -4, 4))
    return list(found)


def lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Proximal gradient with momentum on the mean logistic loss."""
    n, w, b = len(y), np.zeros(r.shape[1]), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    rate = 4 / (np.linalg.norm(r, 2) ** 2 / n + 1)
    v, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        g = 1 / (1 + np.exp(-np.clip(r @ v + vb, -30, 30))) - y
        new = v - rate * (r.T @ g) / n
        new, nb = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0), vb - rate * g.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = new, nb, t2
    return w, b


def loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


class RuleModel:
    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.rules: list[tuple[tuple[Test, ...], float]] = []
        share = float(y.mean()) if len(y) else 0.5
        self.bias = float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -30, 30))
        if len(y) < 20 or share in (0.0, 1.0):
            return
        paths = rules(x, y)
        r = np.stack([holds(x, p) for p in paths], 1).astype(float)
        test = np.arange(len(y)) % 5 == 0
        if 0 < y[test].mean() < 1 and 0 < y[~test].mean() < 1:
            tried = []
            for penalty in (0.02, 0.01, 0.005, 0.002, 0.001, 0.0005):
                w, b = lasso(r[~test], y[~test], penalty)
                tried.append((loss(r[test] @ w + b, y[test]), penalty))
            least = min(tried)[0]
            penalty = next(p for at, p in tried if at <= least * 1.02 + 1e-6)
        else:
            penalty = 0.005
        w, self.bias = lasso(r, y, penalty)
        self.rules = [(p, float(x)) for p, x in zip(paths, w, strict=True) if x]

    def column(self) -> Column:
        z = F.lit(self.bias)
        for path, weight in self.rules:
            met = F.lit(True)
            for f, above, cut in path:
                met = met & ((F.col(NAMES[f]) > cut) if above else (F.col(NAMES[f]) <= cut))
            z = z + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) for each row of docs, written once."""
    return saved(docs.select("doc_id", *[c.alias(n) for n, c in statistics().items()]))


def fit(stats: DataFrame, labels: DataFrame, learn: Column | None = None, rows: int = FIT_ROWS) -> RuleModel:
    known = labels.select("doc_id", "quality").filter("quality in (0, 1)").filter(F.lit(True) if learn is None else learn).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    picked = known.orderBy(order).limit(rows)
    both = stats.join(F.broadcast(picked), "doc_id").orderBy(order, *NAMES).limit(rows)  # two columns of so many rows at most
    data = np.array([[float(v) for v in r] for r in both.select(*NAMES, "quality").collect()]).reshape(-1, len(NAMES) + 1)
    return RuleModel(data[:, :-1], data[:, -1])


def score(stats: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for each row of measured()."""
    found = stats.select("doc_id", model.column().alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
