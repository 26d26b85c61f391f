"""Quality rules combined by weak supervision.

Each rule looks at one measure of a text and votes good (1), bad (-1) or abstains
(0).  Expectation-maximisation over the vote patterns (as many as the rules allow at
most, whatever the input) estimates the share of good documents and, for each rule
when it votes, how often it is right about good documents and about bad ones.  The
posterior probability of "good" takes the place of passing every rule: a short text,
or one with some repeated lines, is kept if the other rules find it fine.

Each measure has a strict rule, which errs now and then, and a lenient one that finds
only gross defects.  Defects that never occur together say nothing about each other,
and two classes alone would let the rarer kind pass as good; so each rule starts from
a stated belief, which weighs as much as the rule's own votes (``trust``).

All document work is built-in functions without a shuffle; the only aggregate counts
the patterns.  Votes are stored with the kept columns, because rows need no key.

Defined cases: a null, empty or wordless text has zero for every measure and fails
the base check; repeated rows get a row each; an empty table gives an empty result
and the starting accuracies; result columns replace input columns of their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.llm.common import SPACES, let, numbered, space_words, without
from tradestar.session import materialize

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def _n_repeat_words(words: Column) -> Column:
    """Words that lie in a window which stands at least twice in the text."""
    k = REPEAT_WINDOW

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda s, i: F.least(F.lit(k), F.coalesce(F.get(starts, i + 1) - s, F.lit(k))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(ordered, lambda o: F.filter(o, lambda p, i: (F.get(o, i - 1)["h"] == p["h"]) | (F.get(o, i + 1)["h"] == p["h"])))
        return let(F.sort_array(F.transform(twice, lambda p: p["i"])), covered)

    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(repeated(w)))

    return F.when(F.size(words) <= k, 0).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measures as longs: words, code points in words, symbols, repeated lines, repeated words, lines with a word, capitals."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def count(chars: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))

    def lines(all_lines: Column) -> Column:
        return let(F.filter(all_lines, lambda x: x.rlike(f"[^{SPACES}]")), lambda own: F.struct(F.size(own).alias("n"), (F.size(own) - F.size(F.array_distinct(own))).alias("dup")))

    words = let(
        space_words(F.col(text_col)),
        lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), _n_repeat_words(w).alias("rep")),
    )
    rest = without(docs, *MEASURES)
    found = rest.select(*rest.columns, F.struct(words.alias("w"), lines(F.split(text, "\n")).alias("l"), count(SYMBOLS).alias("s"), count(r"\p{Lu}").alias("u")).alias("_measured"))
    m = F.col("_measured")
    values = (m["w"]["n"], m["w"]["chars"], m["s"], m["l"]["dup"], m["w"]["rep"], m["l"]["n"], m["u"])
    return found.select(*rest.columns, *[v.cast("long").alias(n) for v, n in zip(values, MEASURES)])


@dataclass(frozen=True)
class Rule:
    """Votes on ``top / bottom`` (0 if bottom is 0): bad outside ``fair``, good inside ``fine`` (default: ``fair``), no vote between them.

    ``sure`` is the belief, before any document is seen, that a good document gets a good vote.
    """

    name: str
    top: str
    bottom: str
    fair: tuple[float, float]
    fine: tuple[float, float] | None = None
    sure: float = 0.9

    def vote(self) -> Column:
        x = F.when(F.col(self.bottom) > 0, F.col(self.top) / F.col(self.bottom)).otherwise(0.0) if self.bottom else F.col(self.top)
        return F.when(~x.between(*self.fair), -1).when(x.between(*(self.fine or self.fair)), 1).otherwise(0).cast("int")


#: Belief of a lenient rule, and that any rule finds a bad document (most have one defect of many).
GROSS, FINDS = 0.999, 0.3
#: Share of good documents before any is seen.
BALANCE = 0.8

RULES = (
    Rule("length", "n_words", "", (50, 100_000), (100, 100_000)),
    Rule("word_length", "word_chars", "n_words", (3, 10), (3.5, 8)),
    Rule("symbols", "n_symbols", "n_words", (0, 0.1), (0, 0.02)),
    Rule("lines", "n_dup_lines", "n_lines", (0, 0.2), (0, 0.05)),
    Rule("repetition", "n_repeat_words", "n_words", (0, 0.1), (0, 0.03)),
    Rule("capitals", "n_upper", "word_chars", (0, 0.2), (0, 0.1)),
    Rule("odd_words", "word_chars", "n_words", (2, 14), sure=GROSS),
    Rule("noise", "n_symbols", "n_words", (0, 0.3), sure=GROSS),
    Rule("copied_lines", "n_dup_lines", "n_lines", (0, 0.5), sure=GROSS),
    Rule("copied_words", "n_repeat_words", "n_words", (0, 0.3), sure=GROSS),
    Rule("shouting", "n_upper", "word_chars", (0, 0.4), sure=GROSS),
)


@dataclass(frozen=True)
class VoteModel:
    """P(good) without votes; for each rule, when it votes, P(good vote) of a good document and P(bad vote) of a bad one."""

    balance: float
    passes: dict[str, float]
    finds: dict[str, float]

    @property
    def accuracy(self) -> dict[str, float]:
        """Share of each rule's votes that are right."""
        return {r: self.balance * p + (1 - self.balance) * self.finds[r] for r, p in self.passes.items()}

    def odds(self) -> float:
        return log(self.balance / (1 - self.balance))

    def weight(self, rule: str, vote: int) -> float:
        """Log odds of good that one vote adds."""
        p, f = self.passes[rule], self.finds[rule]
        return {1: log(p / (1 - f)), -1: log((1 - p) / f), 0: 0.0}[vote]

    def posterior(self, votes: dict[str, Column]) -> Column:
        odds = F.lit(self.odds())
        for rule, vote in votes.items():
            odds = odds + F.when(vote > 0, self.weight(rule, 1)).when(vote < 0, self.weight(rule, -1)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit_votes(
    patterns: list[tuple[dict[str, int], int]],
    belief: dict[str, float],
    balance: float = 0.5,
    trust: float = 1.0,
    rounds: int = 100,
    finds: float | None = None,
) -> VoteModel:
    """EM over (votes, number of documents), from the ``belief`` in each rule and ``balance``.

    ``belief`` holds for good documents, and for bad ones unless ``finds`` is given.
    The beliefs keep the weight of ``trust`` votes for each vote a rule casts, and of ``trust`` documents for each document.
    """
    sees = {r: b if finds is None else finds for r, b in belief.items()}
    model = VoteModel(balance, dict(belief), sees)
    total = sum(n for _, n in patterns)
    cast = {r: sum(n for votes, n in patterns if votes[r]) for r in belief}

    def share(right: float, of: float, start: float, weight: float) -> float:
        return min(0.999, max(0.001, (right + start * weight) / (of + weight))) if of + weight else start

    for _ in range(rounds):
        good = []
        for votes, _ in patterns:
            odds = model.odds() + sum(model.weight(r, v) for r, v in votes.items())
            good.append(1 / (1 + exp(-max(-500.0, min(500.0, odds)))))
        passed, found = {}, {}
        for r, start in belief.items():
            mine = [(votes[r], n * p, n * (1 - p)) for p, (votes, n) in zip(good, patterns) if votes[r]]
            held = trust * cast[r]
            passed[r] = share(sum(g for v, g, _ in mine if v > 0), sum(g for _, g, _ in mine), start, held * balance)
            found[r] = share(sum(b for v, _, b in mine if v < 0), sum(b for _, _, b in mine), sees[r], held * (1 - balance))
        model = VoteModel(share(sum(n * p for p, (_, n) in zip(good, patterns)), total, balance, trust * total), passed, found)
    return model


def judge(docs: DataFrame, keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES, at_least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns (default: all) with the measures, the votes, base_failed, quality (P(good)) and kept."""
    votes = [f"vote_{r.name}" for r in rules]
    added = (*MEASURES, *votes, "base_failed", "quality", "kept")
    measured = measure(docs.select(F.col(text_col).alias("_judged"), *(without(docs, *added).columns if keep is None else keep)), "_judged").drop("_judged")
    voted = materialize(measured.withColumns({v: r.vote() for v, r in zip(votes, rules)}), "quality_votes")
    belief = {r.name: r.sure for r in rules}
    seen = voted.groupBy(*votes).count().collect()  # as many rows as votes can be combined, at most (RULES: 23,328)
    model = fit_votes([(dict(zip(belief, row[:-1])), row[-1]) for row in sorted(map(tuple, seen))], belief, BALANCE, finds=FINDS)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = voted.withColumn("base_failed", failed).withColumn("quality", model.posterior({n: F.col(v) for n, v in zip(belief, votes)}))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= at_least))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rejected ones (columns as they are, of any name)."""
    rows, (text_col,) = numbered(docs, options.pop("text_col", "text"))
    marked = judge(rows.select(F.struct(*rows.columns).alias("_doc"), F.col(text_col).alias("_text")), ["_doc"], text_col="_text", **options)
    return marked.filter("kept").select("_doc.*").toDF(*docs.columns)
