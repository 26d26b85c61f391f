"""Spelling variants: words of a vocabulary that differ by exactly one code point, from pairs of trie nodes.

The vocabulary is sorted, and set end to end; the number of a forward trie node is the
place in that line where the node's prefix first ends.  So a word's prefixes take the
numbers of the word above it as far as the two agree, and new numbers from there on: one
pass over the sorted words numbers all nodes, whole prefixes are never written out, and a word's
last node is the word's own number, ascending in code-point order.  Blocks of
the sorted words are numbered by themselves; what the first word of a block shares with
the words above follows from one short row for each block.  The reversed words number
the suffixes alike.

A word gives the pairs (prefix node, suffix node) around each skipped letter, and those at
each place where a letter could be inserted.  Equal pairs mean equal strings, so a
grouping by the pair is exact: two words that share a skipped pair differ by a replaced
letter, and a word whose insertion pair another word has as a skipped pair is that word
without the letter.  A pair that the same two words would share twice (one of two equal neighbouring
letters skipped) counts where the first of the run is skipped.

A group holds at most one word for each letter of the alphabet, plus one, so it is
bounded whatever the vocabulary, and it is never expanded into pairs: each
member takes its count and the best of the others.

Defined cases: a null text has no words, a null id is empty in the checksum, an empty table
gives no rows; repeated rows count as often as they occur; other columns are not read.  A word
may be of any length: the rows it makes grow with its length, not with the square of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradestar.llm.common import ascii_lower
from tradestar.session import materialize

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
#: One run in this many loses a letter.
DROP_ONE_IN = 97
#: A form is at least this many times as frequent as its variant.
RATIO = 2
#: Words and letters in a block of the sorted vocabulary.
BLOCK_WORDS = 100_000
BLOCK_LETTERS = 2_000_000
#: Rows of a batch of pairs.
AT_ONCE = 50_000


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """One row ``word`` for each run of letters, A-Z lower-cased; a run whose checksum with its document's id is divisible by ``drop_one_in`` loses one letter."""
    clean = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    runs = clean.select("id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"))
    h = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return h.select(F.when(F.col("h") % drop_one_in == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the different words of at least ``min_length`` code points and ``min_count`` rows."""
    return words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _shared(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    # longest k with equal first k letters
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _numbered(words, path: list[int], at: int, above: str = ""):
    """Numbers of each word's prefixes, by depth.

    ``path`` holds the start (place in the line) of the word that each prefix of the first
    word shared with the words above takes its number from, ``at`` the start of the first word.
    """
    first = True
    for w in words:
        keep = len(path) if first else _shared(above, w) + 1
        path = path[:keep] + [at] * (len(w) + 1 - keep)
        yield path
        first, above, at = False, w, at + len(w) + 1


def _spans(path: list[int]) -> list[tuple[int, int]]:
    """(depth of the last, start) of each stretch of equal starts."""
    return [(d, s) for d, s in enumerate(path) if d + 1 == len(path) or path[d + 1] != s]


def _by_block(batches):
    """(block, its rows without the block) of rows sorted by block."""
    held, block = [], None
    for batch in batches:
        for mark, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if mark != block and held:
                yield block, held
                held = []
            block = mark
            held.append(row)
    if held:
        yield block, held


def _summaries(batches):
    """For each block: letters, first and last word, and the starts along the last word's path as stretches."""
    import pyarrow as pa

    for block, rows in _by_block(batches):
        words = [r[0] for r in rows]
        path = []
        for path in _numbered(words, [], 0):
            pass
        spans = _spans(path)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([sum(map(len, words)) + len(words)], pa.int64()), pa.array([words[0]]), pa.array([words[-1]]), pa.array([[d for d, _ in spans]], pa.list_(pa.int64())), pa.array([[s for _, s in spans]], pa.list_(pa.int64()))],
            names=["block", "size", "low", "high", "depths", "starts"],
        )


def _agreeing(batches):
    import pyarrow as pa

    for batch in batches:
        rows = batch.to_pylist()
        names = ["block", "size", "depths", "starts", "shared"]
        shared = [-1 if r["above"] is None else _shared(r["above"], r["low"]) for r in rows]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:4]), pa.array(shared, pa.int64())], names=names)


def _inherited(summaries) -> dict:
    """Block -> (place of its first word, stretches of starts that its first word takes from the words above)."""
    out, place, above = {}, 0, []
    for r in summaries:
        taken = []
        for depth, start in above:
            if r["shared"] < 0 or (taken and taken[-1][0] >= r["shared"]):
                break
            taken.append((min(depth, r["shared"]), start))
        out[r["block"]] = (place, taken)
        path = []
        for depth, start in zip(r["depths"], r["starts"]):
            if start == 0:  # of the block's first word, or of what that takes from above
                path += [(min(depth, d), s) for i, (d, s) in enumerate(taken) if i == 0 or taken[i - 1][0] < depth]
                if depth > r["shared"]:
                    path.append((depth, place))
            else:
                path.append((depth, place + start))
        place, above = place + r["size"], path
    return out


def node_numbers(words: DataFrame, column: str, others: list[str], block_words: int = BLOCK_WORDS, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """``others`` and ``nodes``: the numbers of the trie nodes of every prefix of ``column`` (different values), by depth."""
    size = words.agg(F.count("*"), F.sum(F.length(column))).first()
    blocks = max(1, -(-size[0] // block_words), -(-(size[1] or 0) // block_letters))
    cut = materialize(words.select(F.col(column).alias("key"), *others).repartitionByRange(blocks, "key").withColumn("block", F.spark_partition_id()), "spelling_sorted")
    rows = cut.select("block", "key", *others).repartition(blocks, "block").sortWithinPartitions("block", "key")
    made = rows.select("block", "key").mapInArrow(_summaries, "block int, size long, low string, high string, depths array<long>, starts array<long>")
    # one row for each block
    above = materialize(made, "spelling_blocks").select("block", "size", "low", F.lag("high").over(Window.orderBy("block")).alias("above"), "depths", "starts")
    found = above.mapInArrow(_agreeing, "block int, size long, depths array<long>, starts array<long>, shared long").collect()
    inherited = _inherited(sorted((r.asDict() for r in found), key=lambda r: r["block"]))
    types = [cut.schema[n].dataType.simpleString() for n in others]

    def run(batches):
        import pyarrow as pa

        arrow = [pa.string() if t == "string" else pa.int64() for t in types]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [*arrow, pa.list_(pa.int64())])], names=[*others, "nodes"])

        for block, rows in _by_block(batches):
            place, taken = inherited[block]
            path: list[int] = []
            for depth, start in taken:
                path += [start] * (depth + 1 - len(path))
            out, held = [], 0
            for row, starts in zip(rows, _numbered((r[0] for r in rows), path, place)):
                out.append((*row[1:], [s + d for d, s in enumerate(starts)]))
                held += len(starts)
                if held > AT_ONCE:
                    yield batch_of(out)
                    out, held = [], 0
            if out:
                yield batch_of(out)

    return rows.mapInArrow(run, ", ".join([*(f"{n} {t}" for n, t in zip(others, types)), "nodes array<long>"]))


_PAIR = "prefix long, suffix long, id long, n long, kind int"
#: Kinds of pairs: a skipped letter, the same where it is the first of its run, and a place between letters.
SKIP, SKIP_FIRST, PLACE = 0, 1, 2


def _pairs(batches):
    """Pairs of (prefix node, suffix node) of each word (word, n, prefixes, suffixes)."""
    import numpy as np
    import pyarrow as pa

    def batch_of(parts):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=[c.split()[0] for c in _PAIR.split(", ")])

    for batch in batches:
        parts, held = [], 0
        for word, n, prefixes, suffixes in zip(*(c.to_pylist() for c in batch.columns)):
            size = len(word)
            p, s = np.array(prefixes, np.int64), np.array(suffixes, np.int64)[::-1]
            letters = np.array(list(word))
            first = np.append(True, letters[1:] != letters[:-1])
            rows = 2 * size + 1
            kind = np.concatenate([np.where(first, SKIP_FIRST, SKIP), np.full(size + 1, PLACE)]).astype(np.int32)
            parts.append((np.append(p[:-1], p), np.append(s[1:], s), np.full(rows, p[-1]), np.full(rows, n), kind))
            held += rows
            if held > AT_ONCE:
                yield batch_of(parts)
                parts, held = [], 0
        if parts:
            yield batch_of(parts)


def neighbours(numbered: DataFrame) -> DataFrame:
    """id, n_near and the best near word (``best``: its n and the negative of its id) of each word of (id, word, n, prefixes, suffixes) that has one."""
    pairs = numbered.select("word", "n", "prefixes", "suffixes").mapInArrow(_pairs, _PAIR)
    # at most one word for each letter of the alphabet, and one without
    groups = pairs.groupBy("prefix", "suffix").agg(F.collect_list(F.struct("id", "n", "kind")).alias("m")).filter(F.size("m") > 1)
    near = f"""(x.kind < {PLACE} AND y.kind < {PLACE} AND x.id != y.id) OR (x.kind = {PLACE} AND y.kind = {SKIP_FIRST}) OR (x.kind = {SKIP_FIRST} AND y.kind = {PLACE})"""
    each = groups.select(F.explode(F.expr(f"transform(m, x -> struct(x.id AS id, transform(filter(m, y -> {near}), y -> struct(y.n AS n, -y.id AS minus_id)) AS others))")).alias("x")).select("x.*")
    found = each.filter(F.size("others") > 0).select("id", F.size("others").cast("long").alias("k"), F.array_max("others").alias("best"))
    return found.groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def variants(words: DataFrame, ratio: int = RATIO, block_words: int = BLOCK_WORDS, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """Spelling variants in a vocabulary ``words`` (different ``word``s, n).

    Returns word, form (its near word of largest n, of equal ones the smallest, if that n is at
    least ``ratio`` times the word's; else null), root (the last of the chain of forms, the word
    itself without one), n, n_near, form_n.
    """
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "spelling_words")
    blocks = {"block_words": block_words, "block_letters": block_letters}
    forward = node_numbers(words, "word", ["word", "n"], **blocks)
    backward = node_numbers(words.select(F.reverse("word").alias("drow"), "word"), "drow", ["word"], **blocks)
    joined = forward.withColumnRenamed("nodes", "prefixes").join(backward.withColumnRenamed("nodes", "suffixes"), "word")
    numbered = materialize(joined.withColumn("id", F.element_at("prefixes", -1)), "spelling_nodes")
    names = numbered.select("id", "word", "n")
    near = materialize(names.join(neighbours(numbered), "id", "left").withColumn("form_id", F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.minus_id"))), "spelling_near")

    # a form is at least `ratio` times as frequent, which bounds the chains; each round doubles the steps taken
    most = words.agg(F.max("n"), F.min("n")).first()
    steps, reach = 0, most[1] or 1
    while ratio > 1 and reach * ratio <= (most[0] or 0):
        steps, reach = steps + 1, reach * ratio
    roots = near.filter("form_id IS NOT NULL").select("id", "form_id", F.col("form_id").alias("root_id"))
    for _ in range((max(steps, 1) - 1).bit_length()):
        roots = materialize(roots, "spelling_roots")
        onward = roots.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        roots = roots.join(onward, "root_id", "left").select("id", "form_id", F.coalesce("next_id", "root_id").alias("root_id"))
    form = names.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = names.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    chained = roots.join(form, "form_id").join(root, "root_id").select("id", "form", "form_n", "root")
    out = near.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near")).join(chained, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
