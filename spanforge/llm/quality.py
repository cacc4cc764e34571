"""Quality rules: structural counts, then a hashed n-gram log-likelihood ratio between a trusted target and the corpus,
then a sum over the few words that mark toxic documents.

Words are runs of characters other than space and the control characters 9 to 13. Null text has no words.
A document without n-grams scores 0; null or repeated ids are judged row by row. Extra columns are not read; a kept one
that is called like one of the operator's own columns is returned as ``<name>_input``.
"""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.llm.chunks import set_aside
from spanforge.session import cut

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BUCKETS = 16_384
BROADCAST_IDS = 500_000  # labelled ids that are broadcast at once
MAX_PARTS = 16  # broadcasts of that many, each reading the documents once, before both sides are exchanged
SCALE = 1_000_000  # weights are whole millionths, so that sums don't depend on their order
KEEP_SHARE = 0.001  # of trusted documents whose score may lie under the threshold
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
WORD_EDGE = r"[^\p{L}\p{N}]+"  # toxic words are compared lower-cased and without punctuation
MARK_DEVIATIONS = 6.0  # a word marks toxic documents if its shares of documents differ by this many standard errors
MAX_MARKS = 256
OWN = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "toxicity", "kept"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def _held(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns that are computed once per row: a one-element explode keeps the optimizer from inlining them into
    the lambdas that read them, where they would run again for every element."""
    for name, expr in exprs.items():
        df = df.select("*", F.explode(F.array(expr)).alias(name))
    return df


def _counts(docs: DataFrame, text: str) -> DataFrame:
    """Add the structural counts and ``_words`` to every row; no exchange."""
    w = _held(docs.withColumn("_text", F.coalesce(F.col(text), F.lit(""))), _words=words_of(F.col("_text")))
    w = w.withColumn("n_words", F.size("_words").cast("long"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w = _held(w, _lines=lines).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    w = w.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    w = w.withColumn("n_symbols", F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"))
    w = _held(w, _hashes=F.transform("_words", lambda x: F.xxhash64(x)))
    w = _held(w, _windows=_joined("_hashes", 3))
    # Sorted (hash, position) pairs put equal windows side by side; only texts that repeat one are sorted.
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    w = _held(w, _pairs=F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    near = lambda x, j: F.get("_pairs", j)["h"] == x["h"]
    found = F.filter("_pairs", lambda x, j: F.coalesce(near(x, j - 1), F.lit(False)) | F.coalesce(near(x, j + 1), F.lit(False)))
    w = _held(w, _at=F.sort_array(F.transform(found, lambda x: x["i"])))
    covered = F.aggregate("_at", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])
    w = w.withColumn("n_repeat_words", covered.cast("long"))
    return w.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _joined(hashes: str, n: int) -> Column:
    """A hash for each run of ``n`` consecutive words, from the column of the words' hashes."""
    first = F.slice(F.col(hashes), F.lit(1), F.greatest(F.size(hashes) - (n - 1), F.lit(0)))
    return F.transform(first, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, n)]))


def _grams(hashes: str) -> Column:
    """Hashes of the words and of the word pairs."""
    return F.concat(F.col(hashes), _joined(hashes, 2))


def labelled(labels: DataFrame) -> DataFrame:
    """Every labelled id once: ``good`` (of good quality and not toxic), ``poor``, ``toxic``, and whether its half is the
    one that counts are taken from (``fit``) or the one that thresholds are."""
    said = [F.coalesce(F.max(F.expr(c)), F.lit(False)).alias(n) for n, c in (("good", "quality = 1 and toxic = 0"), ("poor", "quality = 0"), ("toxic", "toxic = 1"))]
    ids = labels.where("doc_id is not null").groupBy("doc_id").agg(*said).where("good or poor or toxic")
    return ids.withColumn("fit", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0)


def labelled_texts(docs: DataFrame, labels: DataFrame, text: str = "text", part: int = BROADCAST_IDS, parts: int = MAX_PARTS) -> DataFrame:
    """``(good, poor, toxic, fit, text)`` of every row of a labelled id, materialised.

    Ids are broadcast ``part`` at a time, each part reading the documents once, so texts without a label never travel;
    labels of more than ``parts`` such parts are joined by an exchange of both sides.
    """
    ids = cut(labelled(labels))
    rows, n = docs.select("doc_id", F.col(text).alias("text")), math.ceil(ids.count() / part)
    flags = ["good", "poor", "toxic", "fit", "text"]
    if n <= 1 or n > parts:
        return cut(rows.join(F.broadcast(ids) if n <= 1 else ids, "doc_id").select(*flags))
    found = [cut(rows.join(F.broadcast(ids.where(F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(n)) == i)), "doc_id").select(*flags)) for i in range(n)]
    return reduce(DataFrame.unionByName, found)


def quantile(rows: DataFrame, column: str, share: float) -> float | None:
    """The exact interpolated quantile over all rows, None without any. Only the tail beyond it is ordered, so it is meant
    for shares near 0 or 1."""
    n = rows.count()
    if not n:
        return None
    at = (n - 1) * share
    low, low_end = math.floor(at), share < 0.5
    tail = rows.select(column).orderBy(F.asc(column) if low_end else F.desc(column)).limit(min(low + 2, n) if low_end else n - low).collect()
    a, b = (r[0] for r in ((tail[low], tail[min(low + 1, n - 1)]) if low_end else (tail[-1], tail[max(len(tail) - 2, 0)])))
    return a if a == b else (low + 1 - at) * a + (at - low) * b


def _bucket_counts(texts: DataFrame, text: str, buckets: int) -> DataFrame:
    hashed = _held(texts.select(F.col(text).alias("_text")), _h=F.transform(words_of(F.col("_text")), lambda x: F.xxhash64(x)))
    return hashed.select(F.explode(_grams("_h")).alias("_g")).select(F.pmod("_g", F.lit(buckets)).cast("int").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gram_weights(docs: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, weight)``: log of target over corpus share in millionths, add-one smoothed; counts cover all rows of the
    corpus ``docs`` and all of the ``target``, which has a column ``text``."""
    wanted = _bucket_counts(target, "text", buckets).withColumnRenamed("n", "target")
    counts = _bucket_counts(docs, text, buckets).withColumnRenamed("n", "raw").join(wanted, "bucket", "left")
    counts = cut(counts.withColumn("target", F.coalesce("target", F.lit(0).cast("long"))))
    total = counts.agg(F.sum("raw").alias("raw_all"), F.sum("target").alias("target_all")).first()
    raw_all, target_all = total["raw_all"] or 0, total["target_all"] or 0
    if not target_all:
        return counts.select("bucket", F.lit(0).cast("long").alias("weight"))
    ratio = F.log((F.col("target") + 1) / F.lit(float(target_all + buckets))) - F.log((F.col("raw") + 1) / F.lit(float(raw_all + buckets)))
    return counts.select("bucket", F.round(ratio * SCALE).cast("long").alias("weight"))


def weight_array(weights: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The weights by bucket: at most ``buckets`` rows, a fixed size whatever the corpus, so they may reach the driver."""
    out = [0] * buckets
    for row in weights.collect():
        out[row["bucket"]] = row["weight"]
    return out


def plain_words(text: Column) -> Column:
    """Hashes of the distinct lower-cased words."""
    words = F.filter(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_EDGE)), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def toxicity(text: Column, marks: dict[int, int]) -> Column:
    """Sum of the weights of the marking words that occur, each once: other words can't drown them."""
    if not marks:
        return F.lit(0).cast("bigint")
    table = F.from_json(F.lit(json.dumps({str(k): v for k, v in marks.items()})), "map<string,bigint>")
    hits = F.array_intersect(plain_words(text), F.from_json(F.lit(json.dumps(list(marks))), "array<bigint>"))
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, x: a + F.element_at(table, x.cast("string")))


def score(docs: DataFrame, weights: list[int], text: str = "text", keep: list[str] | None = None, marks: dict[int, int] | None = None) -> DataFrame:
    """Columns ``keep`` of every row, the structural counts, ``llr``: mean weight per n-gram, in millionths,
    and ``toxicity`` by ``marks``.

    The weights are one folded array literal, so scoring is a map over rows: no join, no exchange, no exploded rows.
    """
    keep = keep or ["doc_id"]
    kept = {c: f"_k{i}" for i, c in enumerate(keep)}
    names = dict(zip(keep, set_aside(docs.select(*keep), OWN).columns, strict=True))
    counted = _counts(docs.select(*[F.col(c).alias(k) for c, k in kept.items()], F.col(text).alias("_in")), "_in")
    table = F.from_json(F.lit(json.dumps(weights)), "array<bigint>")
    counted = _held(counted, _pairs2=_joined("_hashes", 2))
    grams = F.concat("_hashes", "_pairs2")
    total = F.aggregate(grams, F.lit(0).cast("bigint"), lambda a, x: a + F.get(table, F.pmod(x, F.lit(len(weights))).cast("int")))
    n = F.size("_hashes") + F.size("_pairs2")
    out = OWN[:6]
    return counted.select(*[F.col(k).alias(names[c]) for c, k in kept.items()], *out, F.when(n > 0, total / n).otherwise(F.lit(0.0)).alias("llr"), toxicity(F.col("_text"), marks or {}).alias("toxicity"))


def fit(docs: DataFrame, texts: DataFrame, text: str = "text", buckets: int = BUCKETS, keep_share: float = KEEP_SHARE) -> tuple[list[int], float]:
    """Weights, and the score under which a document is rejected, from the ``labelled_texts``.

    Trusted: labelled good quality and not toxic. One half of all trusted documents gives the weights, the other half and
    all that are labelled poor give the threshold, so that no document is measured by its own counts: halfway between
    the score that all but ``keep_share`` of the former exceed and the one that all but ``keep_share`` of the latter
    stay under; the former if these overlap. Without structurally sound documents of both kinds nothing is rejected by
    the ratio.
    """
    weights = weight_array(gram_weights(docs, texts.where("good and fit"), text, buckets), buckets)
    measured = texts.select((F.col("good") & ~F.col("fit")).alias("_good"), F.col("poor").alias("_poor"), "text").where("_good or _poor")
    scored = cut(score(measured, weights, "text", ["_good", "_poor"]).where("not base_failed").select("_good", "_poor", "llr"))
    good, poor = quantile(scored.where("_good"), "llr", keep_share), quantile(scored.where("_poor"), "llr", 1 - keep_share)
    if good is None or poor is None:
        return weights, float("-inf")
    return weights, (good + poor) / 2 if poor < good else good


def fit_toxic(texts: DataFrame, keep_share: float = KEEP_SHARE) -> tuple[dict[int, int], float]:
    """Words that mark toxic documents with their weights, and the toxicity over which a document is rejected.

    One half of all trusted documents and of all labelled toxic, whatever their quality, gives the words: those in
    a larger share of the toxic documents than chance explains, weighted by the log of the shares' ratio. The other
    halves give the threshold, as in ``fit``: halfway between what all but ``keep_share`` of the trusted stay under and
    what all but ``keep_share`` of the toxic exceed; the former if these overlap.
    """
    held = texts.where("fit and (good or toxic)").select("good", "toxic", "text")
    row = held.agg(F.count_if("toxic").alias("n_bad"), F.count_if("good").alias("n_good")).first()
    n_bad, n_good = row["n_bad"], row["n_good"]
    if not n_bad or not n_good:
        return {}, float("inf")
    counts = held.select("good", "toxic", F.explode(plain_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count_if("toxic").alias("bad"), F.count_if("good").alias("good"))
    both = (F.col("bad") + F.col("good") + 0.5) / F.lit(n_bad + n_good + 1.0)
    apart = (F.col("bad") / F.lit(float(n_bad)) - F.col("good") / F.lit(float(n_good))) / F.sqrt(both * (1 - both) * F.lit(1 / n_bad + 1 / n_good))
    ratio = F.log((F.col("bad") + 0.5) / F.lit(n_bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(n_good + 1.0))
    found = counts.select("word", apart.alias("apart"), F.round(ratio * SCALE).cast("long").alias("weight")).where(F.col("apart") >= MARK_DEVIATIONS)
    marks = {r["word"]: r["weight"] for r in found.orderBy(F.desc("apart"), "word").limit(MAX_MARKS).collect()}
    rest = cut(texts.where("not fit and (good or toxic)").select("good", "toxic", toxicity(F.col("text"), marks).alias("t")))
    good, bad = quantile(rest.where("good"), "t", 1 - keep_share), quantile(rest.where("toxic"), "t", keep_share)
    if good is None or bad is None:
        return {}, float("inf")
    return marks, (good + bad) / 2 if bad > good else good


def judge_quality(docs: DataFrame, labels: DataFrame, text: str = "text", keep: list[str] | None = None, **kw) -> DataFrame:
    """Every row of ``docs``: columns ``keep``, structural counts, ``base_failed``, ``llr``, ``toxicity``, ``kept``."""
    texts = labelled_texts(docs, labels, text)
    weights, threshold = fit(docs, texts, text, **kw)
    marks, most = fit_toxic(texts, **{k: v for k, v in kw.items() if k != "buckets"})
    return score(docs, weights, text, keep, marks).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)) & (F.col("toxicity") <= F.lit(most)))
