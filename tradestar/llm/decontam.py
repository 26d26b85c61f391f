"""Benchmark decontamination with training suffix arrays.

Each task cuts its documents into shards of bounded size and builds the shard's
word-level suffix array.  Words outside the benchmark cannot be part of a match,
so suffixes that begin with one are left out, and the order is refined only as
deep as the longest test item reaches.  Every test suffix is then binary-searched
in every shard: its neighbours in the array give the longest verbatim match, and
the interval of suffixes that share its first words gives all places.  Nothing is
shuffled.  The test items are searched in blocks of bounded size, one block after
the other over all documents.

Defined cases: a null or wordless text has no words, no hits and is clean; a null
or wordless item has no windows; an item with a null id hits words but is not
listed; items of one id count once; repeated documents get a row each; an empty
benchmark leaves every document clean, an empty corpus gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.common import bytes_of, numbered, without

#: Words of a lower-cased text as UTF-8: digits, letters and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Words of one shard (a longer document is a shard of its own).
SHARD_WORDS = 2_000_000
#: Bytes of test texts searched at once; they are held by the driver and every task.
BLOCK_BYTES = 16_000_000
#: Test suffixes compared at a time.
SEARCHED_AT_ONCE = 20_000

RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


class ItemBlock:
    """Some test items: their vocabulary, suffixes and windows as arrays."""

    def __init__(self, items, window: int):
        import numpy as np

        self.vocabulary, ids, starts, lengths, self.names = {}, [], [], [], []
        for name, text in items:
            words = WORD.findall((text or "").encode().lower())
            if words:
                starts.append(len(ids))
                lengths.append(len(words))
                self.names.append(name)
                ids += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
        lengths = np.array(lengths, dtype=np.int64)
        self.words = np.array(ids, dtype=np.int32)
        self.item = np.repeat(np.arange(len(lengths)), lengths)
        self.at = np.arange(len(ids)) - np.repeat(np.array(starts, dtype=np.int64), lengths)
        self.left = np.repeat(lengths, lengths) - self.at
        span = np.minimum(lengths, window)[self.item] if len(ids) else self.at
        self.span = np.where(self.left >= span, span, 0)  # words of the window that starts here, 0 if none does
        self.depth = int(lengths.max()) if len(lengths) else 0


def suffix_array(words, depth: int, bits: int):
    """Places of the non-zero ``words`` in the order of the ``depth`` words from there on (0 ends a document)."""
    import numpy as np

    per = max(1, min(63 // bits, depth))
    padded = np.concatenate([words, np.zeros(max(per, 1), words.dtype)])
    places = np.flatnonzero(words)
    key = np.zeros(len(places), np.int64)
    for k in range(per):
        key = key << bits | padded[places + k]
    order = np.argsort(key, kind="stable")
    array, key = places[order], key[order]
    if not len(array):
        return array
    slots = np.arange(len(array))
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.maximum.accumulate(np.where(fresh, slots, 0))
    rank = np.zeros(len(words) + 1, np.int64)
    rank[array] = first + 1
    known = per
    open_slots = slots
    while known < depth:
        group = rank[array[open_slots]]
        shared = np.concatenate([[False], group[1:] == group[:-1]])
        shared = shared | np.concatenate([shared[1:], [False]])
        open_slots, group = open_slots[shared], group[shared]
        if not len(open_slots):
            break
        here = array[open_slots]
        key = group * (len(array) + 2) + rank[np.minimum(here + known, len(words))]
        order = np.argsort(key, kind="stable")
        here, key = here[order], key[order]
        array[open_slots] = here
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[here] = np.maximum.accumulate(np.where(fresh, open_slots, 0)) + 1
        known *= 2
    return array


def _common(words, places, test, starts, lengths):
    """Length of the common prefix of the text at ``places`` and the tests at ``starts`` (at most ``lengths``), and whether the text sorts first."""
    import numpy as np

    steps = np.arange(int(lengths.max()) if len(lengths) else 0)
    text = words[np.minimum(places[:, None] + steps, len(words) - 1)]
    want = test[np.minimum(starts[:, None] + steps, len(test) - 1)]
    differ = (text != want) | (steps >= lengths[:, None])
    differ = np.concatenate([differ, np.ones((len(places), 1), bool)], axis=1)
    common = differ.argmax(axis=1)
    inside = common < lengths
    c = np.where(inside, common, 0)
    rows = np.arange(len(places))
    return np.minimum(common, lengths), (inside & (text[rows, c] < want[rows, c])) if len(steps) else inside


def _bound(words, array, test, starts, lengths, after: bool):
    """First slot whose suffix is not smaller (``after``: is greater and does not begin with it) than the test's first ``lengths`` words."""
    import numpy as np

    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(array), np.int64)
    while len(act := np.flatnonzero(low < high)):
        mid = (low[act] + high[act]) // 2
        common, less = _common(words, array[mid], test, starts[act], lengths[act])
        right = less | (common >= lengths[act]) if after else less
        low[act[right]] = mid[right] + 1
        high[act[~right]] = mid[~right]
    return low


def search(words, array, block, wanted):
    """Longest match of each wanted test suffix, and where it would be inserted."""
    import numpy as np

    best = np.zeros(len(wanted), np.int64)
    if not len(array):
        return best
    for i in range(0, len(wanted), SEARCHED_AT_ONCE):
        s = wanted[i : i + SEARCHED_AT_ONCE]
        at = _bound(words, array, block.words, s, block.left[s], False)
        for slot, there in ((at - 1, at > 0), (at, at < len(array))):
            k = np.flatnonzero(there)
            common, _ = _common(words, array[slot[k]], block.words, s[k], block.left[s[k]])
            best[i + k] = np.maximum(best[i + k], common)
    return best


def places_of(words, array, block, suffixes, lengths):
    """Every place where the first ``lengths`` words of the test ``suffixes`` stand: (index into suffixes, place)."""
    import numpy as np

    which, where = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in range(0, len(suffixes), SEARCHED_AT_ONCE):
        s, n = suffixes[i : i + SEARCHED_AT_ONCE], lengths[i : i + SEARCHED_AT_ONCE]
        low = _bound(words, array, block.words, s, n, False)
        size = _bound(words, array, block.words, s, n, True) - low
        skip = np.repeat(np.cumsum(size) - size, size)
        where.append(array[np.repeat(low, size) + np.arange(size.sum()) - skip])
        which.append(np.repeat(np.arange(i, i + len(s)), size))
    return np.concatenate(which), np.concatenate(where)


def distinct_windows(block, starts):
    """The different windows among those that begin at ``starts``: a start of each, and its items as (from, to, item numbers).

    Items may share a window (or repeat one); it is searched for once, so the places
    found are bounded by the words of the shard, not by the items.
    """
    import numpy as np

    if not len(starts):
        return starts, np.zeros(1, np.int64), np.zeros(0, np.int64)
    span = block.span[starts]
    at = np.arange(int(span.max()))
    inside = at < span[:, None]
    words = np.where(inside, block.words[np.minimum(starts[:, None] + at, len(block.words) - 1)], -1)
    _, first, window = np.unique(words, axis=0, return_index=True, return_inverse=True)
    owned = np.unique(np.stack([window.ravel(), block.item[starts]], axis=1), axis=0)
    return starts[first], np.searchsorted(owned[:, 0], np.arange(len(first) + 1)), owned[:, 1]


def shards_of(texts, vocabulary):
    """Shards of the texts in order: (first text, words as ids with a 0 after each text, start of each text)."""
    from itertools import repeat

    import numpy as np

    held, total, first = [], 0, 0
    get = vocabulary.get
    for i, text in enumerate(texts):
        found = WORD.findall(text.lower()) if text else ()
        if held and total + len(found) > SHARD_WORDS:
            yield first, *_joined(held)
            held, total, first = [], 0, i
        ids = np.zeros(len(found) + 1, np.int32)
        ids[:-1] = np.fromiter(map(get, found, repeat(0)), dtype=np.int32, count=len(found))
        held.append(ids)
        total += len(ids)
    if held:
        yield first, *_joined(held)


def _joined(held):
    import numpy as np

    sizes = np.array([len(x) for x in held])
    return np.concatenate(held), np.cumsum(sizes) - sizes, sizes - 1


def item_blocks(items: DataFrame, window: int, item_id: str, item_text: str, block_bytes: int = BLOCK_BYTES):
    """The items as :class:`ItemBlock` after :class:`ItemBlock`, each of about ``block_bytes`` of text, one at a time on the driver."""
    size = items.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    keyed = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text"))
    for b in range(count):
        part = keyed if count == 1 else keyed.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == b)
        yield b == 0, b == count - 1, ItemBlock(sorted(part.collect(), key=lambda r: (r[0] or "", r[1] or "")), window)


def annotate(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str] | None = None,
    window: int = WINDOW,
    one_in: int = ONE_IN,
    id_cols: tuple[str, str] = ("item_id", "text"),
    text_col: str = "text",
    prefix: str = "",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``keep`` columns of each document (default: all) with n_words, n_hit, n_items, items_sha256 and contaminated.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an
    item (of all its words, if it has fewer).  The results replace columns of their names.
    """
    names = [prefix + r for r in RESULT]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    state = ["_hit_words", "_hit_items"]
    sc = docs.sparkSession.sparkContext
    df = docs.select(F.col(text_col).alias("_searched"), *keep)
    for first, last, block in item_blocks(items, window, *id_cols, block_bytes):
        shared = sc.broadcast(block)
        passed = df.schema.fields if first else df.schema.fields[: -len(state)]
        passed = passed[1:] if last else passed
        types = (T.LongType(), T.LongType(), T.LongType(), T.StringType(), T.BooleanType())
        added = [T.StructField(n, t) for n, t in zip(names, types)] if last else [T.StructField(state[0], T.BinaryType()), T.StructField(state[1], T.ArrayType(T.StringType()))]
        df = df.mapInArrow(_searching(shared, first, last, one_in, names if last else state), T.StructType([*passed, *added]))
    return df


def _searching(shared, first: bool, last: bool, one_in: int, names: list[str]):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        block = shared.value
        bits = max(1, len(block.vocabulary).bit_length())
        starts, owned, owners = distinct_windows(block, np.flatnonzero(block.span))
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            columns = batch.columns if first else batch.columns[:-2]
            hits, items, words_of = [], [], []
            for lead, words, begin, sizes in shards_of(bytes_of(batch.column(0)), block.vocabulary):
                array = suffix_array(words, block.depth, bits)
                best = search(words, array, block, starts)
                windows = np.flatnonzero(best >= block.span[starts])
                found = starts[windows]
                which, where = places_of(words, array, block, found, block.span[found])
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, where, 1)
                np.add.at(change, where + block.span[found[which]], -1)
                hit = np.cumsum(change[:-1]) > 0
                of = np.searchsorted(begin, where, side="right") - 1
                # each document's different windows, then their items
                doc, window = np.divmod(np.unique(of * len(owned) + windows[which]), len(owned))
                n_owners = owned[window + 1] - owned[window]
                item = owners[np.repeat(owned[window] - np.cumsum(n_owners) + n_owners, n_owners) + np.arange(n_owners.sum())]
                pairs = np.unique(np.repeat(doc, n_owners) * (len(block.names) + 1) + item)
                own = [set() for _ in begin]
                for doc, item in zip(*(x.tolist() for x in np.divmod(pairs, len(block.names) + 1))):
                    if block.names[item] is not None:
                        own[doc].add(block.names[item])
                items += own
                words_of += sizes.tolist()
                if first and last:
                    hits += np.add.reduceat(hit, begin).tolist() if len(begin) else []
                else:
                    hits += [np.packbits(hit[b : b + s]) for b, s in zip(begin, sizes)]
            if not first:
                before = batch.column(len(batch.columns) - 2).to_pylist()
                hits = [h | np.frombuffer(b, np.uint8) for h, b in zip(hits, before)]
                for own, more in zip(items, batch.column(len(batch.columns) - 1).to_pylist()):
                    own.update(more)
            if not last:
                added = [pa.array([h.tobytes() for h in hits], pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, *added], names=[*batch.schema.names[: len(columns)], *names])
                continue
            n_hit = hits if first else [int(np.bitwise_count(h).sum()) for h in hits]
            added = [
                pa.array(words_of, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
                pa.array([h > 0 and one_in * h >= w for h, w in zip(n_hit, words_of)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*columns[1:], *added], names=[*batch.schema.names[1 : len(columns)], *names])

    return run


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones (columns as they are, of any name)."""
    prefix = "_decontam_"
    rows, (text_col,) = numbered(docs, options.pop("text_col", "text"))
    marked = annotate(rows, items, prefix=prefix, text_col=text_col, **options)
    return marked.filter(~F.col(f"{prefix}contaminated")).select(*rows.columns).toDF(*docs.columns)


def longest_matches(docs: DataFrame, items: DataFrame, min_words: int = WINDOW, id_cols: tuple[str, str] = ("item_id", "text"), id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Longest verbatim match of each test suffix over all shards, with every location.

    ``(item_id string, item_word, length, id_col, doc_word)``: words counted from 0; suffixes
    whose longest match is below ``min_words`` are left out.  Items of one id and position share it.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sc = docs.sparkSession.sparkContext
    found = None
    for _, _, block in item_blocks(items, WINDOW, *id_cols, block_bytes):
        part = docs.select(id_col, text_col).mapInArrow(_locating(sc.broadcast(block), min_words, id_col), f"item_id string, item_word long, length long, `{id_col}` {kind}, doc_word long")
        found = part if found is None else found.unionByName(part)
    top = found.groupBy("item_id", "item_word").agg(F.max("length").alias("length"))
    return found.join(top.select(F.col("item_id").alias("_i"), F.col("item_word").alias("_w"), F.col("length").alias("_l")), (F.col("item_id").eqNullSafe(F.col("_i"))) & (F.col("item_word") == F.col("_w")) & (F.col("length") == F.col("_l")), "left_semi").distinct()


def _locating(shared, min_words: int, id_col: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        block = shared.value
        bits = max(1, len(block.vocabulary).bit_length())
        every = np.arange(len(block.words))
        for batch in batches:
            for lead, words, begin, sizes in shards_of(bytes_of(batch.column(1)), block.vocabulary):
                array = suffix_array(words, block.depth, bits)
                best = search(words, array, block, every)
                found = every[best >= max(1, min_words)]
                which, where = places_of(words, array, block, found, best[found])
                of = np.searchsorted(begin, where, side="right") - 1
                suffix = found[which]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.names[i] for i in block.item[suffix]], pa.string()),
                        pa.array(block.at[suffix], pa.int64()),
                        pa.array(best[suffix], pa.int64()),
                        batch.column(0).take(pa.array(lead + of, pa.int64())),
                        pa.array(where - begin[of], pa.int64()),
                    ],
                    names=["item_id", "item_word", "length", id_col, "doc_word"],
                )

    return run
