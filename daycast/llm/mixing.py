"""Mixing documents to target domain weights by soft membership.

A document's domain is not known but for the rows of a labelled table; a classifier fitted
on those gives every document its posterior over the domains. A document with n tokens
and posterior p then brings rate * n * p[k] expected tokens to domain k, and the rates are
the nonnegative numbers whose expected domain totals fit the targets best (least squares),
found by projected gradient from rate 1 for all.

Classifier: multinomial naive Bayes over hashed lower-case words, as SQL aggregates. Its
sample is the labelled documents of smallest hash, at most ``sample_docs`` of them, with
their whole texts; labels whose document is not in the table are left out before the
sample is taken. Every document's whole text is scored: per word one
look-up in the fitted table (``buckets`` rows, a literal of the plan). The log-likelihood
is divided by ``temperature`` times the square root of the word count, because words of
one text are not independent and undivided posteriors are all 0 or 1.

Least squares: with w the documents' token shares, m = sum(w * r * p) the expected domain
shares, T the targets and G = sum(w * p * p'), the minimised function is
(m - T)' G^-1 (m - T) / 2 (G's pseudo-inverse, where domains coincide). In the inner product
weighted by w its gradient at a document is p' u with u = G^-1 (m - T), and its curvature is
at most 1, so projected gradient takes rates to max(0, rate - p' u), accelerated by momentum
that starts anew where it points uphill. A step is one aggregate over (tokens, posterior,
rate) rows of a written table; only u, K numbers, and the momentum are kept, and every rate
follows from those in one expression. The steps end where a projected step from momentum's
point moves the rates (mean over tokens) by at most the tolerance. Where the targets are far
out of reach, the fit is a few documents with enormous rates, which no gradient step
reaches soon; what ``max_steps`` steps leave to do, proximal steps finish: they add
damping / 2 times the rates' squared distance from those before, and their best rates
max(0, rate - p' u) come from a damped Newton iteration on u. If those do not reach
the optimality condition (of the bound 0, too), an error is raised.

With ``keep``, a domain is named whose documents are not to be thinned out for the others'
sake: the targets of the others are limits, lowered to the table's own expected shares where
those are smaller, and ``keep`` gets the rest, at least its own share. So a table that has less of
the others than the limits keeps rate 1 throughout.

Defined cases
- Null or blank text: 0 tokens, posterior equal to the domains' sample shares; any rate
  fits, and it has the same rate formula as the others.
- No usable label: every posterior is even over the domains.
- A domain of the targets that no label names gets posterior 0, and its target can't be
  met; the fit is then the nearest. A labelled domain without a target has target 0.
- Labels without a document, or with a null id or domain, teach nothing; a repeated label
  counts once, and of different labels for one document the alphabetically first.
- No token in the whole table: every rate is 1.
- Input columns named like an output are replaced by it; all others are carried through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import col, others, stage_table, text_of

#: Moves of Newton's iteration in one proximal step, of which a few are needed.
MOVES = 200
#: Gradient steps after which the rates are written, so that no pass repeats more of them.
CUT = 16
SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def words_of(text: Column) -> Column:
    """The words of a text: runs free of ASCII space."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str, text_col: str, sample_docs: int,
                buckets: int) -> tuple[list[float], dict[str, list[float]]] | None:
    """(log shares by domain, log word likelihoods by domain and bucket), or None without labels."""
    label = labelled.select(col(id_col).alias("id"), F.col("domain")).dropna().where(F.col("domain").isin(domains)).groupBy("id").agg(F.min("domain").alias("domain"))
    order = F.xxhash64(F.col("id").cast("string"), F.lit("mix"))
    there = label.join(docs.select(col(id_col).alias("id")), "id", "left_semi")
    chosen = stage_table(there.withColumn("order", order).orderBy("order", "id").limit(sample_docs).drop("order"))
    texts = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").select("domain", words_of(F.lower(F.col("text"))).alias("words"))
    shares = {r.domain: r.n for r in chosen.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shares:
        return None
    counts = (sample.select("domain", F.explode("words").alias("word")).groupBy("domain", _bucket(F.col("word"), buckets).alias("bucket"))
              .agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(shares.values())
    prior = [math.log(shares[d] / n) if shares.get(d) else -math.inf for d in domains]
    table = {d: [1.0] * buckets for d in domains}
    for r in counts:
        table[r.domain][r.bucket] += r.n
    likelihood = {}
    for d in domains:
        total = math.log(sum(table[d]))
        likelihood[d] = [math.log(x) - total for x in table[d]]
    return prior, likelihood


def _literal(values: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")  # folded to one literal


def _adder(values: Column):
    return lambda total, spot: total + F.get(values, spot)


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text",
               sample_docs: int = 4000, buckets: int = 8192, temperature: float = 0.5) -> DataFrame:
    """``docs`` without its text, with ``n_tokens`` (words) and ``posterior`` (doubles in the
    order of ``domains`` that sum to 1)."""
    fitted = fit_domains(docs, labelled, domains, id_col, text_col, sample_docs, buckets)
    rest = others(docs, [text_col, "n_tokens", "posterior"])
    words = docs.select(*rest, words_of(F.lower(text_of(text_col))).alias("__words"))
    k = len(domains)
    if fitted is None:
        return words.select("*", F.size("__words").cast("long").alias("n_tokens"), F.array_repeat(F.lit(1.0 / k), k).alias("posterior")).drop("__words")
    prior, likelihood = fitted
    spots = words.withColumn("__words", F.transform("__words", lambda w: _bucket(w, buckets)))
    scores = [F.aggregate("__words", F.lit(0.0), _adder(_literal(likelihood[d]))) for d in domains]
    scored = spots.select(*rest, F.size("__words").cast("long").alias("n_tokens"), *[s.alias(f"__s{i}") for i, s in enumerate(scores)])
    scale = F.lit(temperature) * F.sqrt(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"))
    soft = [F.lit(p) + F.col(f"__s{i}") / scale for i, p in enumerate(prior)]
    top = F.greatest(*soft) if k > 1 else soft[0]
    raw = scored.select(*rest, "n_tokens", F.array(*soft).alias("__l"), top.alias("__top"))
    raw = raw.select(*rest, "n_tokens", F.transform("__l", lambda x: F.exp(x - F.col("__top"))).alias("__e"))
    total = F.aggregate("__e", F.lit(0.0), lambda s, x: s + x)
    raw = raw.select(*rest, "n_tokens", "__e", total.alias("__sum"))
    return raw.select(*rest, "n_tokens", F.transform("__e", lambda x: x / F.col("__sum")).alias("posterior"))


def _whitener(gram: np.ndarray) -> np.ndarray:
    """W with W' gram W = 1, on the directions that ``gram`` has."""
    values, vectors = np.linalg.eigh(gram)
    kept = values > 1e-12 * values[-1]
    return vectors[:, kept] / np.sqrt(values[kept])


def _after(steps: list[list[float]], posterior: Column, before: Column, rate: Column) -> Column:
    """A struct of the rates ``before`` and after the last of ``steps``, and the point from which
    that one started. A step is its momentum and K numbers u: from start = rate + momentum *
    (rate - before) the next rate is max(0, start - p' u). The numbers are one literal array,
    so that the generated code is the same for all steps."""
    first = F.struct(before.alias("before"), rate.alias("start"), rate.alias("rate"))
    if not steps:
        return first
    width, flat = len(steps[0]), _literal([float(x) for step in steps for x in step])
    number = lambda i, j: F.get(flat, i * width + j)

    def step(s: Column, i: Column) -> Column:
        start = s["rate"] + number(i, 0) * (s["rate"] - s["before"])
        move = sum((number(i, j + 1) * F.get(posterior, F.lit(j)) for j in range(width - 1)), F.lit(0.0))
        return F.struct(s["rate"].alias("before"), start.alias("start"), F.greatest(F.lit(0.0), start - move).alias("rate"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), first, step)


def _rate(steps: list[list[float]], posterior: Column) -> Column:
    """The rate that ``steps`` make of 1."""
    return _after(steps, posterior, F.lit(1.0), F.lit(1.0))["rate"]


def _dot(u, posterior: str = "posterior") -> Column:
    return sum((F.lit(float(x)) * F.get(posterior, F.lit(i)) for i, x in enumerate(u)), F.lit(0.0))


def _written(work: DataFrame, steps: list[list[float]]) -> DataFrame:
    after = _after(steps, F.col("posterior"), F.col("before"), F.col("rate"))
    return stage_table(work.select("n_tokens", "posterior", after.alias("s")).select("n_tokens", "posterior", "s.before", "s.rate"))


def _descend(work: DataFrame, total: float, inverse: np.ndarray, targets: np.ndarray, shares: np.ndarray, max_steps: int,
             tolerance: float) -> tuple[DataFrame, list[list[float]], np.ndarray, bool]:
    """Accelerated projected gradient from the rates of ``work``: (table with the rates at the
    end, steps, expected shares there, whether the optimum is reached)."""
    k = len(targets)
    steps: list[list[float]] = []
    pending: list[list[float]] = []
    start, age, push = shares, 1.0, 0.0
    while len(steps) < max_steps:
        step = [push, *map(float, inverse @ (start - targets))]
        steps.append(step)
        pending.append(step)
        after = _after(pending, F.col("posterior"), F.col("before"), F.col("rate"))
        n, r, y, to = F.col("n_tokens").cast("double"), F.col("s.before"), F.col("s.start"), F.col("s.rate")
        now = work.select("n_tokens", "posterior", after.alias("s")).agg(
            F.sum(n * F.abs(to - y)).alias("moved"), F.sum(n * (y - to) * (to - r)).alias("uphill"),
            *[F.sum(n * to * F.get("posterior", F.lit(i))).alias(f"m{i}") for i in range(k)]).first()
        new = np.array([now[f"m{i}"] for i in range(k)]) / total
        if now.moved / total <= tolerance:
            return work, steps, new, True
        if now.uphill > 0:
            age = 1.0
        older, age = age, (1 + math.sqrt(1 + 4 * age * age)) / 2
        push = (older - 1) / age
        start, shares = new + push * (new - shares), new
        if len(pending) == CUT:
            work, pending = _written(work, pending), []
    return _written(work, pending) if pending else work, steps, shares, False


@dataclass
class _Measured:
    """Rates max(0, rate - p' u) of a table: their expected domain shares, the dual function's
    part that depends on the rows, its curvature, and how far the rates moved."""

    shares: np.ndarray
    value: float
    curve: np.ndarray
    moved: float


def _measure(work: DataFrame, total: float, k: int, u: list[float]) -> _Measured:
    p = [F.get("posterior", F.lit(i)) for i in range(k)]
    n, r = F.col("n_tokens").cast("double"), F.col("to")
    free = F.when(r > 0, n).otherwise(F.lit(0.0))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    rates = work.withColumn("to", F.greatest(F.lit(0.0), F.col("rate") - _dot(u)))
    now = rates.agg(F.sum(n * r * r).alias("v"), F.sum(n * F.abs(r - F.col("rate"))).alias("d"), *[F.sum(n * r * p[i]).alias(f"m{i}") for i in range(k)],
                    *[F.sum(free * p[i] * p[j]).alias(f"h{i}_{j}") for i, j in pairs]).first()
    curve = np.array([[now[f"h{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    return _Measured(np.array([now[f"m{i}"] for i in range(k)]) / total, now.v / total / 2, curve / total, now.d / total)


def _step(measure, white: np.ndarray, targets: np.ndarray, back: np.ndarray, damping: float, tolerance: float) -> tuple[list[float], _Measured]:
    """The K numbers of a proximal step, and what was measured at its end. Newton's
    iteration on the convex dual; a move is halved until the dual falls enough."""
    v = np.zeros(white.shape[1])
    now = measure((white @ v).tolist())
    value = lambda m, v: m.value + targets @ (white @ v) + damping / 2 * v @ v
    for _ in range(MOVES):
        slope = white.T @ (targets - now.shares) + damping * v
        if np.abs(back @ slope).max() <= tolerance:
            return (white @ v).tolist(), now
        move = -np.linalg.solve(white.T @ now.curve @ white + damping * np.eye(len(v)), slope)
        part = 1.0
        while part > 1e-9:
            to = v + part * move
            then = measure((white @ to).tolist())
            if value(then, to) <= value(now, v) + 1e-4 * part * (slope @ move) + 1e-14:
                break
            part /= 2
        v, now = to, then
    raise RuntimeError(f"the mix's rates are not found after {MOVES} moves of a step")


def fit_rates(members: DataFrame, targets: list[float], max_steps: int = 100, tolerance: float = 1e-9,
              finish_steps: int = 30) -> tuple[list[list[float]], list[float]]:
    """(steps, expected domain shares at their end) for rows of ``n_tokens`` and ``posterior``;
    ``targets`` are shares of the table's tokens. Rates are ``_rate(steps, posterior)``. Raises
    RuntimeError where ``finish_steps`` proximal steps after ``max_steps`` gradient steps do
    not reach the fit."""
    k = len(targets)
    p = [F.get("posterior", F.lit(i)) for i in range(k)]
    n = F.col("n_tokens").cast("double")
    first = members.agg(F.sum(n).alias("n"), *[F.sum(n * p[i]).alias(f"m{i}") for i in range(k)],
                        *[F.sum(n * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    if not first.n:
        return [], list(targets)
    gram = np.array([[first[f"g{min(i, j)}_{max(i, j)}"] / first.n for j in range(k)] for i in range(k)])
    own = np.array([first[f"m{i}"] / first.n for i in range(k)])
    white = _whitener(gram)
    work = members.select("n_tokens", "posterior", F.lit(1.0).alias("before"), F.lit(1.0).alias("rate"))
    work, steps, shares, reached = _descend(work, first.n, white @ white.T, np.array(targets), own, max_steps, tolerance)
    if reached:
        return steps, shares.tolist()
    damping = 1e-3
    for _ in range(finish_steps):
        step, end = _step(lambda u, now=work: _measure(now, first.n, k, u), white, np.array(targets), gram @ white, damping, tolerance / 10)
        if any(step):
            steps.append([0.0, *step])
            work = _written(work, steps[-1:])
        if damping * end.moved <= tolerance:  # the gradient of a rate above 0 is damping times its move
            return steps, end.shares.tolist()
        damping = max(damping / 100, 1e-7)
    raise RuntimeError(f"the mix's rates are not found after {len(steps)} steps: expected shares {end.shares.tolist()} for targets {list(targets)}")


def within_limits(members: DataFrame, limits: list[float], keep: int, tokens_factor: float) -> list[float]:
    """Target shares of the table's tokens: of each domain its limit, or its own expected
    share where that is smaller; the rest, and at least its own share, of the domain ``keep``."""
    n = F.col("n_tokens").cast("double")
    own = members.agg(F.sum(n).alias("n"), *[F.sum(n * F.get("posterior", F.lit(i))).alias(f"m{i}") for i in range(len(limits))]).first()
    if not own.n:
        return limits
    shares = [own[f"m{i}"] / own.n for i in range(len(limits))]
    targets = [min(x, m) for x, m in zip(limits, shares, strict=True)]
    targets[keep] = max(shares[keep], tokens_factor - (sum(targets) - targets[keep]))
    return targets


@dataclass
class Mix:
    """Rates by document, the targets that were fitted, the expected shares under
    the rates (both by domain, as shares of the table's tokens) and the number of steps."""

    rates: DataFrame
    targets: dict[str, float]
    reached: dict[str, float]
    steps: int


def fit_mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
            tokens_factor: float = 1.0, max_steps: int = 100, keep: str | None = None, **classifier) -> Mix:
    """Rates at which the documents' expected domain totals are ``targets``.

    ``labelled`` has ``id_col`` and ``domain``; ``targets`` maps domains to weights, which are
    scaled to sum to ``tokens_factor`` times the table's tokens; with ``keep`` those of the other
    domains are limits. The rates have the columns of
    ``docs`` but the text, with ``n_tokens``, ``posterior`` (by domain, alphabetically) and ``rate``.
    """
    if not targets or min(targets.values()) < 0 or not sum(targets.values()):
        raise ValueError("targets need nonnegative weights that are not all 0")
    domains = sorted(targets)
    weights = [targets[d] * tokens_factor / sum(targets.values()) for d in domains]
    members = stage_table(posteriors(docs, labelled, domains, id_col, text_col, **classifier))
    if keep is not None:
        weights = within_limits(members, weights, domains.index(keep), tokens_factor)
    steps, reached = fit_rates(members, weights, max_steps)
    kept = [col(c) for c in members.columns if c.lower() != "rate"]
    rates = members.select(*kept, _rate(steps, F.col("posterior")).alias("rate"))
    return Mix(rates, dict(zip(domains, weights, strict=True)), dict(zip(domains, reached, strict=True)), len(steps))


def mix_to_targets(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """The rates of ``fit_mix``."""
    return fit_mix(docs, labelled, targets, **options).rates


def copies_of(rate: Column, *key: Column) -> Column:
    """A whole number of copies whose mean is the rate: rounded up where the key's hash,
    as a fraction, is below the rate's. The same key is always rounded alike."""
    fraction = F.pmod(F.xxhash64(*key, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (fraction < rate - F.floor(rate)).cast("long")).cast("long")
