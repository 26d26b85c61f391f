"""Language identification by Bayesian evidence fusion.

The likelihood of a page's text under each language comes from byte trigrams
counted in a bounded sample of labelled documents.  Declared markup language,
address suffix and host are further evidence: how often each goes with each
language is counted over all pages by grouped aggregation of the text posteriors.
The prior of a host is smoothed towards its domain, and that towards all pages; a
page's own share is taken out of its host's counts, so it is not its own witness.

Defined cases: a null page has no text evidence; a missing declaration, suffix or
host is no evidence (the prior of all pages holds); ties go to the first language by
name; repeated rows get a row each; without labelled documents, or without pages,
the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.common import ascii_lower, bytes_of
from tradestar.llm.warc import html_parts
from tradestar.session import materialize

#: Labelled documents the text model is fitted on at most (those of smallest hash).
MAX_TRAIN = 4000
BUCKETS = 1 << 15
#: A text counts as this many independent trigrams at most.
EVIDENCE = 40.0
#: Pages' worth of the parent's distribution in that of a host or domain, and of the whole in that of a declaration or suffix.
SMOOTHING = 5.0


def trigrams(text: bytes):
    """Bucket of each byte trigram of a lower-cased text."""
    import numpy as np

    b = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    return (((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def train_text(docs: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """Languages, and log P(trigram bucket | language) as a matrix."""
    import numpy as np

    known = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    sample = known.select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(max_train)
    picked = known.join(F.broadcast(sample), id_col).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa

        totals = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1))):
                if text:
                    counts = np.bincount(trigrams(text), minlength=BUCKETS)
                    totals[lang] = totals.get(lang, 0) + counts
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["lang", "bucket", "n"])

    # at most BUCKETS rows for each language of the sample
    rows = picked.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r.lang for r in rows})
    counts = np.full((len(langs), BUCKETS), 0.5)
    for r in rows:
        counts[langs.index(r.lang), r.bucket] += r.n
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)) if langs else counts


def read_pages(pages: DataFrame, table, n_langs: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(id_col, host, declared, text)``: text is the log likelihood of each language, tempered."""
    shared = pages.sparkSession.sparkContext.broadcast(table)
    host = ascii_lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    picked = pages.select(F.col(html_col).alias("_html"), F.col(id_col), F.when(host != "", host).alias("host"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        logs = shared.value
        for batch in batches:
            declared, found = [], []
            for html in batch.column(0).to_pylist():
                text, _, lang, _ = html_parts(html or "")
                declared.append(lang.split("-")[0].split("_")[0] or None)
                at = trigrams(text.encode())
                found.append(logs[:, at].sum(axis=1) * min(1.0, EVIDENCE / len(at)) if len(at) else np.zeros(n_langs))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(declared, pa.string()), pa.array([f - f.max() for f in found], pa.list_(pa.float64()))], names=[id_col, "host", "declared", "text"])

    return picked.mapInArrow(run, T.StructType([*picked.schema.fields[1:], T.StructField("declared", T.StringType()), T.StructField("text", T.ArrayType(T.DoubleType()))]))


def _softmax(logs: Column) -> Column:
    """Of an array whose largest entry is near zero."""
    raised = F.transform(logs, lambda x: F.exp(x))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _sums(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Sum of the arrays ``p`` by key, as an array ``c`` and its total ``t``."""
    added = df.groupBy(*keys).agg(F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(n)]).alias("c"))
    return added.withColumn("t", F.aggregate("c", F.lit(0.0), lambda a, b: a + b))


def fuse(read: DataFrame, langs: list[str], id_col: str = "page_id", smoothing: float = SMOOTHING) -> DataFrame:
    """One row per row of :func:`read_pages`: text_lang, lang and probability from all the evidence."""
    n, k = len(langs), smoothing
    read = read.withColumn("p", _softmax(F.col("text")))
    domain, suffix = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.regexp_extract("host", r"([^.]+)$", 1)
    total = _sums(read, n).first()  # one row
    shares = [((c or 0.0) + 1.0 / n) / ((total["t"] or 0.0) + 1) for c in total["c"]]
    whole = F.array(*[F.lit(x) for x in shares])

    def evidence(df: DataFrame, key: str, out: str) -> DataFrame:
        """log P(key | language), up to a constant: smoothed share of the key's pages over the language's share of all."""
        value = F.transform("c", lambda c, i: F.log((c + k * F.get(whole, i)) / (F.col("t") + k) / F.get(whole, i)))
        return df.select(key, value.alias(out))

    hosts = materialize(_sums(read.filter("host is not null"), n, "host").withColumns({"domain": domain, "suffix": suffix}), "langid_hosts")
    by_domain = _sums(hosts.withColumnRenamed("c", "p"), n, "domain").select("domain", F.transform("c", lambda c, i: (c + k * F.get(whole, i)) / (F.col("t") + k)).alias("parent"))
    by_suffix = evidence(_sums(hosts.withColumnRenamed("c", "p"), n, "suffix"), "suffix", "suffix_log")
    known = materialize(hosts.join(by_domain, "domain").join(by_suffix, "suffix").select(F.col("host").alias("_host"), "suffix", "c", "t", "parent", "suffix_log"), "langid_host_priors")
    told = materialize(evidence(_sums(read.filter("declared is not null"), n, "declared"), "declared", "declared_log").withColumnRenamed("declared", "_declared"), "langid_declared")
    joined = read.join(known, F.col("host") == F.col("_host"), "left").join(told, F.col("declared") == F.col("_declared"), "left")
    prior = F.transform("c", lambda c, i: F.log((F.greatest(c - F.get("p", i), F.lit(0.0)) + k * F.get("parent", i)) / (F.greatest(F.col("t") - 1, F.lit(0.0)) + k)))
    prior = F.coalesce(prior, F.transform(whole, lambda x: F.log(x)))
    logs = F.transform("text", lambda x, i: x + F.get("_prior", i) + F.coalesce(F.get("suffix_log", i), F.lit(0.0)) + F.coalesce(F.get("declared_log", i), F.lit(0.0)))
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda a: F.get(names, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    fused = joined.withColumn("_prior", prior).withColumn("_total", logs).withColumn("_total", F.transform("_total", lambda x: x - F.array_max("_total"))).withColumn("_q", _softmax(F.col("_total")))
    return fused.select(id_col, "host", "suffix", "declared", best(F.col("text")).alias("text_lang"), best(F.col("_q")).alias("lang"), F.array_max("_q").alias("probability"))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_train: int = MAX_TRAIN) -> DataFrame:
    """``(id_col, host, suffix, declared, text_lang, lang, probability)`` for each page."""
    langs, table = train_text(docs, max_train)
    if not langs:
        return pages.select(id_col, *[F.lit(None).cast(t).alias(c) for c, t in (("host", "string"), ("suffix", "string"), ("declared", "string"), ("text_lang", "string"), ("lang", "string"), ("probability", "double"))]).limit(0)
    return fuse(materialize(read_pages(pages, table, len(langs), id_col, url_col, html_col), "langid_pages"), langs, id_col)
