"""Quality rules as weak supervision: rules vote or abstain, EM learns how far each can be trusted.

Every rule looks at one document and says *good*, *bad* or nothing. Expectation-maximisation over the
counts of vote patterns estimates, for each rule, how often it gives each vote on good and on bad
documents, from its agreement with the other rules; the posterior probability of *good* then decides.
The corpus is DataFrame work: one pass computes the measures of a document inside its row, one
map-side combined aggregation counts the vote patterns (at most 3 to the power of the number of rules,
whatever the corpus), the fit is a small computation over that table, and each pattern's
probability is joined back to the rows.

Defined cases: a null or empty text has no words, fails the base rules and is not kept; equal rows get
equal results; an empty table gives an empty result; other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import let, matches, packed, white_words
from tickloom.session import stage

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """SQL conditions over the measures; where neither holds, the rule abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 20", "n_words >= 50"),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words", "word_chars between 3.8 * n_words and 7 * n_words"),
    Rule("symbols", "n_symbols > 0.2 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 and n_dup_lines > 0.5 * n_lines", "n_dup_lines <= 0.2 * n_lines"),
    Rule("distinct_words", "n_words >= 50 and n_distinct < (case when n_words < 2000 then 0.25 else 0.1 end) * n_words", "n_distinct >= 0.3 * n_words"),
    Rule("shouting", "n_words >= 10 and n_shouted > 0.5 * n_words", "n_shouted <= 0.1 * n_words"),
)


def _repeat_positions(grams: Column) -> Column:
    """Ascending positions of the values that occur twice or more."""

    def neighbours(s: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            before, after = F.get(s, i - 1), F.get(s, i + 1)
            return F.coalesce(before["gram"] == x["gram"], F.lit(False)) | F.coalesce(after["gram"] == x["gram"], F.lit(False))

        return F.array_sort(F.transform(F.filter(s, same), lambda x: x["at"]))

    return let(F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at")))), neighbours)


def repeated_words(hashes: Column) -> Column:
    """Words inside any window of eight words that is found at least twice in the text.

    Takes the words' hashes; a window's hash is made of the hashes of its halves.
    """

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.get(at, i + 1) - p))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def from_grams(grams: Column) -> Column:
        repeated = F.size(F.array_distinct(grams)) < F.size(grams)
        return F.when(repeated, let(_repeat_positions(grams), covered)).otherwise(F.lit(0).cast("long"))

    def joined(part: Column, width: int, body) -> Column:
        starts = F.slice(part, F.lit(1), F.greatest(F.size(part) - width, F.lit(0)))
        return let(F.transform(starts, lambda h, i: F.xxhash64(h, F.get(part, i + width))), body)

    return joined(hashes, 1, lambda two: joined(two, 2, lambda four: joined(four, 4, from_grams)))


def measures(text: Column) -> Column:
    """Struct of the measures of one text; each expensive array is built once per row."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of(w: Column, hashes: Column, line: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(matches(text, "[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
            repeated_words(hashes).alias("n_repeat_words"),
            F.size(line).cast("long").alias("n_lines"),
            F.size(F.array_distinct(hashes)).cast("long").alias("n_distinct"),
            F.size(matches(text, r"\p{Lu}{2,}")).cast("long").alias("n_shouted"),
        )

    def from_words(w: Column) -> Column:
        return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(lines, lambda line: of(w, h, line)))

    return let(white_words(text), from_words)


def votes(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """1 for good, -1 for bad, 0 for no opinion, as columns ``vote_<rule>``."""
    return [F.expr(f"case when {r.bad} then -1 when {r.good} then 1 else 0 end").alias(f"vote_{r.name}") for r in rules]


#: First belief: how often a rule says bad, nothing and good of good documents, and of bad ones.
BELIEF = {"good": (0.02, 0.03, 0.95), "bad": (0.6, 0.1, 0.3)}
SHARES = {"good": 0.8, "bad": 0.2}
OPINIONS = (-1, 0, 1)
GOOD = "good"
Model = dict[str, tuple[float, dict[str, tuple[float, float, float]]]]


def _climb(seen: np.ndarray, n: np.ndarray, share: np.ndarray, rates: np.ndarray, prior: np.ndarray, rounds: int, tolerance: float) -> tuple:
    """EM from the given classes: log-likelihood, shares (class) and rates (class, rule, opinion).

    ``seen`` is (pattern, rule, opinion), one-hot; ``prior`` are pseudo-documents, (class, rule, opinion).
    """
    flat, loglik = seen.reshape(len(seen), seen.shape[1] * len(OPINIONS)), 0.0
    held = prior.sum(axis=(1, 2)) / seen.shape[1]
    for _ in range(rounds):
        scores = flat @ np.log(rates).reshape(len(share), -1).T + np.log(share)
        top = scores.max(axis=1, keepdims=True, initial=-np.inf)
        weight = np.exp(scores - top)
        loglik = float(n @ (top[:, 0] + np.log(weight.sum(axis=1))))
        part = n[:, None] * weight / weight.sum(axis=1, keepdims=True)
        sums = (part.T @ flat).reshape(rates.shape) + prior
        new_share, new_rates = part.sum(axis=0) + held, sums / sums.sum(axis=2, keepdims=True)
        new_share /= new_share.sum()
        change = max(np.abs(new_share - share).max(), np.abs(new_rates - rates).max())
        share, rates = new_share, new_rates
        if change < tolerance:
            break
    return loglik, share, rates, prior


def _classes(seen: np.ndarray, n: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Shares and rates of as many classes as the votes give reason for (Bayesian information criterion)."""
    rules = seen.shape[1]
    first = np.array([SHARES[k] for k in BELIEF])
    belief = np.array([np.tile(BELIEF[k], (rules, 1)) for k in BELIEF])
    best = _climb(seen, n, first, belief, 10.0 * first[:, None, None] * belief, rounds, tolerance)
    if not n.sum():
        return best[1], best[2]
    common = np.einsum("p,pro->ro", n, seen) + 1e-3 * np.array(BELIEF["good"])
    cost = 0.5 * (1 + ((common >= 1).sum(axis=1) - 1).clip(0).sum()) * math.log(n.sum())
    common /= common.sum(axis=1, keepdims=True)
    while True:
        found = []
        for r in range(rules):
            marked = n * seen[:, r, 0]
            if marked.sum():
                start = np.einsum("p,pro->ro", marked, seen) / marked.sum() + 0.01 * common
                start /= start.sum(axis=1, keepdims=True)
                size = 0.5 * marked.sum() / n.sum()
                classes = [np.append(best[1] * (1 - size), size), *(np.concatenate([old, [x]]) for old, x in ((best[2], start), (best[3], common)))]
                found.append(_climb(seen, n, *classes, rounds, tolerance))
        next_best = max(found, key=lambda f: f[0], default=best)
        if next_best[0] - best[0] <= cost:
            return best[1], best[2]
        best = next_best


def _p_good(rows: DataFrame, model: Model, rules: tuple[Rule, ...]) -> DataFrame:
    """Column ``p_good``: the probability of all good classes together, given the votes."""
    likely = {}
    for kind, (share, rates) in model.items():
        terms = [f"{math.log(share)!r}D"]
        for r in rules:
            cases = " ".join(f"when {o} then {math.log(p)!r}D" for o, p in zip(OPINIONS, rates[r.name]))
            terms.append(f"case vote_{r.name} {cases} end")
        likely[kind] = f"exp({' + '.join(terms)})"
    scored = rows.select("*", *[F.expr(x).alias(f"l_{kind}") for kind, x in likely.items()])
    good = " + ".join(f"l_{kind}" for kind in model if kind.startswith("good"))
    return scored.withColumn("p_good", F.expr(f"({good}) / ({' + '.join(f'l_{kind}' for kind in model)})")).drop(*[f"l_{kind}" for kind in model])


def estimate(counts: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 200, tolerance: float = 1e-4) -> Model:
    """EM over vote patterns and their ``n``: by class, its share and how often each rule says bad, nothing and good.

    A class is a kind of documents on which the rules' votes are independent. It starts with one good
    and one bad class, and takes further ones, which begin at the documents that one rule calls bad and
    are free from there, while they raise the likelihood by more than their rates cost. So a class
    needs rules that agree: bad votes that go with no other rule's votes or silence are errors of
    their rule, at whatever rate, and bad documents that fail in one way only have a class of their own
    where a second rule tells them apart. No rate is bounded and no class belongs to a rule. A class is bad if
    its documents get half a bad vote more than those of the class with the fewest. Ten pseudo-documents of ``BELIEF``
    decide where there are hardly any documents. The table has at most a row for each vote pattern, so
    the fit is one small computation.
    """
    names = [f"vote_{r.name}" for r in rules]
    rows = sorted(tuple(r) for r in counts.select(*names, "n").collect())
    table = np.array(rows, float).reshape(len(rows), len(names) + 1)
    seen = (table[:, :-1, None] == np.array(OPINIONS)).astype(float)
    share, rates = _classes(seen, table[:, -1], rounds, tolerance)
    bad_votes = rates[:, :, 0].sum(axis=1)
    bad = bad_votes - bad_votes.min() > 0.5
    model: Model = {}
    for k in np.argsort(bad_votes, kind="stable"):
        kind = "bad" if bad[k] else GOOD
        same = sum(name.startswith(kind) for name in model)
        model[kind + (str(same + 1) if same else "")] = (float(share[k]), {r.name: tuple(map(float, x)) for r, x in zip(rules, rates[k])})
    return model


def judge(rows: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, keep_row: bool = True) -> DataFrame:
    """Columns ``row`` (the whole input row), the measures, votes, ``base_failed``, ``p_good`` and ``kept``.

    The rows with their votes are written once, so that the texts are measured in one pass.
    ``keep_row=False`` leaves all but ``doc_id`` out of ``row``.
    """
    content = rows[f"`{text}`"]
    held = rows if keep_row else rows.select("doc_id", content)
    measured = packed(held, m=measures(content)).select("row" if keep_row else F.struct("row.doc_id").alias("row"), "m.*")
    voted = stage(measured.select("*", *votes(rules)), "quality-votes")
    names = [f"vote_{r.name}" for r in rules]
    patterns = stage(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "vote-patterns")
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    known = _p_good(patterns, estimate(patterns, rules), rules).drop("n")
    scored = voted.join(F.broadcast(known), names).select(*voted.columns, failed.alias("base_failed"), "p_good")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs).filter("kept").select("row.*")
