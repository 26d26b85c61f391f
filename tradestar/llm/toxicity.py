"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, mild insult, threat, target, negation, reporting
verb, quotation mark, clause end, other).  Transducers for negation scope, reported
speech and threats rewrite the symbols, a last one reads a clause and emits its
matches with their context, and all four are composed into one machine.  A
document's score is a logistic function of the weights of its matched clauses.

The insult lexicon (words and stems) and the clause weights are learned from a
bounded sample of labelled documents; the closed word lists are part of the grammar.

Defined cases: a null or empty text matches nothing and gets the score of no match;
rows without labels are scored alike; a null label or a label without an id is not
used; of several labels of one id the larger holds; without usable labels the
lexicon is empty and stated weights hold; repeated rows get a row each; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.llm.common import bytes_of, let
from tradestar.session import materialize

#: Labelled documents the lexicon and the weights are fitted on at most (those of smallest hash).
MAX_TRAIN = 20_000
#: A form belongs to the lexicon if its excess in toxic documents has this likelihood ratio (G²) and this log odds ratio.
MIN_G2, MIN_ODDS = 24.0, 2.5
STRONG_ODDS = 4.5
#: Stems are word beginnings of these lengths.
STEMS = (4, 5, 6, 7, 8)
#: A stem takes the place of its words if it occurs in so many times the toxic documents of the most frequent of them.
STEM_GAIN = 1.3
#: Share of the most frequent form's documents from which a form is frequent.
FREQUENT = 0.1
NEGATION_SCOPE = 3
THRESHOLD = 0.7

TARGETS = frozenset("you your yourself he she they them him her his their people everyone du dich dir dein deine ihr euch er sie tu toi te vous votre ton ta il elle ils elles usted tú ti tus él ella ellos ustedes".split())
NEGATIONS = frozenset("not no never neither nor isn't aren't wasn't don't cannot without kein keine nicht nie niemals ohne pas ne jamais sans ni nunca jamás sin".split())
REPORTS = frozenset("said says say quoted quote wrote claimed called calls reported according sagte sagt schrieb laut dit disait écrit selon dijo dice escribió según".split())
INTENTS = frozenset("will shall gonna going must should werde werden wird vais va allons voy vamos".split())
HARMS = frozenset("kill hurt destroy beat burn shoot murder töten verletzen schlagen tuer frapper brûler matar golpear quemar".split())

INSULT, MILD, HARM, INTENT, TARGET, NEGATION, REPORT, QUOTE, END, OTHER = "IMHWTNRQBO"
FEATURES = ("strong", "mild", "threat", "directed", "negated", "reported")
#: Weights (bias first) where there are no labels to learn from.
STATED = (-3.0, 4.0, 2.5, 4.0, 0.5, -1.0, -1.0)


class Transducer:
    """Deterministic finite-state transducer: ``step(state, symbol) -> (state, output symbol)``."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other: Transducer) -> Transducer:
        """The composition: the other machine reads what this one writes."""

        def step(state, symbol):
            mine, out = self.step(state[0], symbol)
            theirs, final = other.step(state[1], out)
            return (mine, theirs), final

        return Transducer((self.start, other.start), step)

    def table(self, alphabet) -> tuple[list[dict], int]:
        """Arcs of the states that can be reached, as one dictionary for each state."""
        numbers, arcs, queue = {self.start: 0}, [], [self.start]
        for state in queue:
            row = {}
            for symbol in alphabet:
                following, out = self.step(state, symbol)
                if following not in numbers:
                    numbers[following] = len(numbers)
                    queue.append(following)
                row[symbol] = (numbers[following], out)
            arcs.append(row)
        return arcs, 0


def negation(scope: int = NEGATION_SCOPE) -> Transducer:
    """Marks the insults and threats within ``scope`` words after a negation."""

    def step(left, s):
        if s == NEGATION:
            return scope, OTHER
        if s == END:
            return 0, s
        return max(0, left - 1), s + "-" if left and s in (INSULT, MILD, HARM) else s

    return Transducer(0, step)


def reported() -> Transducer:
    """Marks what stands after a reporting verb in its clause, or within quotation marks."""

    def step(state, s):
        verb, quoted = state
        if s == END:
            return (False, quoted), s
        if s == REPORT:
            return (True, quoted), OTHER
        if s == QUOTE:
            return (verb, not quoted), OTHER
        return state, s + "r" if (verb or quoted) and s[0] in (INSULT, MILD, HARM) else s

    return Transducer((False, False), step)


def threats() -> Transducer:
    """A verb of harm is a threat only after a word of intent in its clause."""

    def step(intent, s):
        if s == END:
            return False, s
        if s == INTENT:
            return True, OTHER
        return intent, OTHER if s[0] == HARM and not intent else s

    return Transducer(False, step)


def clauses() -> Transducer:
    """Reads a clause; at its end writes what it matched, as the features of one clause."""

    def step(state, s):
        kinds, negated, told, target = state
        if s == END:
            return ("", True, True, False), (INSULT in kinds, MILD in kinds, HARM in kinds, target, negated, told) if kinds else None
        if s == TARGET:
            return (kinds, negated, told, True), None
        if s[0] not in (INSULT, MILD, HARM):
            return state, None
        return ("".join(sorted({*kinds, s[0]})), negated and "-" in s, told and "r" in s, target), None

    return Transducer(("", True, True, False), step)


def grammar() -> list[dict]:
    """Arcs of the composed machine."""
    return negation().then(reported()).then(threats()).then(clauses()).table((INSULT, MILD, HARM, INTENT, TARGET, NEGATION, REPORT, QUOTE, END, OTHER))[0]


class Lexicon(dict):
    """Symbol of each word; words are looked up once and kept."""

    KEPT = 500_000

    def __init__(self, words: dict[str, str], stems: dict[str, str]):
        super().__init__()
        self.fixed = {w: s for s, known in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (INTENT, INTENTS), (HARM, HARMS)) for w in known}
        self.fixed |= dict.fromkeys(".!?;:,\n", END) | dict.fromkeys('"“”„«»', QUOTE) | words
        self.stems = stems

    def __missing__(self, word: str) -> str:
        symbol = self.fixed.get(word)
        if symbol is None:
            symbol = next((self.stems[word[:k]] for k in STEMS if word[:k] in self.stems), OTHER)
        if len(self) >= self.KEPT:
            self.clear()
        self[word] = symbol
        return symbol


def count_clauses(text: str, lexicon: Lexicon, arcs: list[dict], pattern) -> list[int]:
    """Features summed over the matched clauses of a text."""
    symbols = list(map(lexicon.__getitem__, pattern.findall(text.lower())))
    totals = [0] * len(FEATURES)
    if INSULT not in symbols and MILD not in symbols and HARM not in symbols:
        return totals
    state = 0
    for s in [*symbols, END]:
        state, found = arcs[state][s]
        if found:
            totals = [a + b for a, b in zip(totals, found)]
    return totals


#: Letters and apostrophes, or one mark that ends a clause or a quotation.
TOKEN = r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:,\n\"“”„«»]"


def features(docs: DataFrame, words: dict[str, str], stems: dict[str, str], keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``found``, the clause features of each whole text."""
    from pyspark.sql import types as T

    def run(batches):
        import re

        import numpy as np
        import pyarrow as pa

        lexicon, arcs, pattern = Lexicon(words, stems), grammar(), re.compile(TOKEN)
        for batch in batches:
            rows = [count_clauses(t.decode("utf-8", "replace"), lexicon, arcs, pattern) if t else [0] * len(FEATURES) for t in bytes_of(batch.column(0))]
            flat = pa.array(np.array(rows, dtype=np.float64).ravel() if rows else np.empty(0))
            found = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(FEATURES), dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], found], names=[*keep, "found"])

    picked = docs.select(F.col(text_col).alias("_read"), *keep)
    return picked.mapInArrow(run, T.StructType([*picked.schema.fields[1:], T.StructField("found", T.ArrayType(T.DoubleType()))]))


def _stems_of(words: str, k: int) -> Column:
    return F.transform(F.filter(words, lambda w: F.length(w) >= k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))


def learn_lexicon(train: DataFrame, text_col: str = "text") -> tuple[dict[str, str], dict[str, str]]:
    """Words and stems that mark toxic documents of ``train (text, toxic)``, with their symbols.

    Copies would make every word of a toxic text look significant: of the texts
    that share their smallest, then their largest, three-word shingle hash only one
    is counted.  A form must also explain documents that no better form explains,
    or be among the frequent ones.
    """
    from math import log

    listed = F.regexp_extract_all(F.lower(text_col), F.lit(r"\p{L}+"), F.lit(0))
    shingles = lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    split = train.filter(F.col(text_col).isNotNull()).select("toxic", listed.alias("listed")).filter(F.size("listed") > 0)
    marked = split.select("toxic", F.array_distinct("listed").alias("words"), let(shingles(F.col("listed")), lambda h: F.struct(F.array_min(h).alias("a"), F.array_max(h).alias("b"))).alias("h"))
    for end in ("a", "b"):
        marked = marked.groupBy("toxic", F.col(f"h.{end}").alias("_k")).agg(F.min(F.struct("h", "words")).alias("_d")).select("toxic", "_d.words", "_d.h")
    forms = F.array_distinct(F.flatten(F.array("words", *[_stems_of("words", k) for k in STEMS])))
    docs = materialize(marked.select("toxic", F.xxhash64("words").alias("doc"), forms.alias("forms")), "toxicity_forms")
    n1, n0 = docs.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not n1 or not n0:
        return {}, {}
    each = docs.select("toxic", "doc", F.explode("forms").alias("form"))
    counts = each.groupBy("form").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    share = n1 / (n1 + n0)
    a, b, n = F.col("a").cast("double"), F.col("b").cast("double"), (F.col("a") + F.col("b")).cast("double")
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    g2 = 2 * (term(a, n * share) + term(b, n * (1 - share)))
    odds = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    marks = counts.withColumns({"odds": odds, "g2": g2}).filter((F.col("g2") >= MIN_G2) & (F.col("odds") >= MIN_ODDS))
    # all of this is bounded by the sample of max_train documents
    rows = each.filter("toxic = 1").join(marks, "form").groupBy("form", "a", "odds", "g2").agg(F.collect_set("doc").alias("docs")).collect()
    found = {r.form: r for r in rows}
    chosen = {}
    for form, r in sorted(found.items(), key=lambda x: (-len(x[0]), x[0])):
        if form.endswith("*"):
            inside = [f for f in (*chosen, *found) if f != form and f.startswith(form[:-1]) and (f in chosen or not f.endswith("*"))]
            if r.a < STEM_GAIN * max((found[f].a for f in inside), default=0):
                continue
            for f in inside:
                chosen.pop(f, None)
                if not f.endswith("*"):
                    found[f] = found[f].__class__(**{**found[f].asDict(), "g2": 0.0})
        chosen[form] = r
    chosen = {f: r for f, r in chosen.items() if found[f].g2 > 0}
    top, explained, kept = max((r.a for r in chosen.values()), default=0), set(), {}
    for form, r in sorted(chosen.items(), key=lambda x: (-x[1].g2, x[0])):
        new = set(r.docs) - explained
        if r.a >= FREQUENT * top or len(new) >= max(2, 0.2 * r.a):
            kept[form] = INSULT if r.odds >= min(STRONG_ODDS, log(n0 + 1)) else MILD
            explained |= new
    return {f: s for f, s in kept.items() if not f.endswith("*")}, {f[:-1]: s for f, s in kept.items() if f.endswith("*")}


def fit_weights(x, y, penalty: float = 0.05, rounds: int = 50):
    """Bias and weights of a logistic regression by Newton's method."""
    import numpy as np

    x = np.column_stack([np.ones(len(x)), np.log1p(x)])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, *[penalty] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


class ToxicityModel:
    """Lexicon and clause weights."""

    def __init__(self, words: dict[str, str], stems: dict[str, str], weights):
        self.words, self.stems, self.weights = words, stems, [float(w) for w in weights]

    def score(self, docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
        """The ``keep`` columns, score (0 to 1) and predicted."""
        found = features(docs, self.words, self.stems, keep, text_col)
        odds = F.lit(self.weights[0])
        for i, w in enumerate(self.weights[1:]):
            odds = odds + w * F.log1p(F.col("found")[i])
        score = 1 / (1 + F.exp(-odds))
        return found.select(*keep, score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fit on at most ``max_train`` documents whose label is ``usable`` (a condition on the id)."""
    import numpy as np

    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    known = known.filter(usable) if usable is not None else known
    sample = known.groupBy(id_col).agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64(id_col), id_col).limit(max_train)
    # ids and labels of at most max_train documents
    labelled = materialize(docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(sample), id_col).select("text", "toxic"), "toxicity_train")
    words, stems = learn_lexicon(labelled)
    rows = features(labelled, words, stems, ["toxic"]).groupBy("toxic", "found").count().collect()
    if len({r.toxic for r in rows}) < 2 or not (words or stems):
        return ToxicityModel(words, stems, STATED)
    # equal feature vectors are one row here: repeat them by their count
    x = np.repeat([r.found for r in rows], [r["count"] for r in rows], axis=0)
    y = np.repeat([r.toxic for r in rows], [r["count"] for r in rows])
    return ToxicityModel(words, stems, fit_weights(x, y))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)``; labels of held-out ids are not used."""
    model = train(docs, labels, ~held_out(F.col(id_col)), id_col=id_col, text_col=text_col)
    scored = model.score(docs, [id_col], text_col)
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", "predicted")
