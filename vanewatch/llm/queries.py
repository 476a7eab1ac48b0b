"""The registered queries of this subpackage; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.llm import chunks, classifier, jaccard, language, mixing, packing, periods, repeats, rules, tokenfiles, tokens, twins, urls, whitening
from vanewatch.llm.frames import table, words_of
from vanewatch.llm.sampling import crc_bucket
from vanewatch.session import fresh_dir

#: Vocabulary file of the token queries; a file with the same name must lie on every executor.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


@query("op8_quality_rules", twins.QUALITY_RULES)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = rules.quality_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", *rules.BASE, "base_failed", "kept")


@query(
    "op10_exact_dedup",
    r"""
    with d as (
      select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as plain
      from documents
    ), g as (
      select doc_id, sha256(plain) as text_sha256,
             first_value(doc_id) over w as keep_id, row_number() over w as place,
             count(*) over (partition by plain) as group_size
      from d
      window w as (partition by plain order by length(t) desc, doc_id nulls last)
    )
    select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from g
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = chunks.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixture(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@query(
    "op4_url_filters",
    r"""
    with p as (
      select page_id,
             coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
      from pages
    ), r(verdict, rule) as (
      values ('block', 'net/'), ('allow', 'example.net/en/'), ('block', 'example.com/de/'), ('allow', 'org/fr/')
    ), s as (
      select verdict, rule, split_part(rule, '/', 1) as rule_host, substr(rule, strpos(rule, '/')) as rule_path from r
    )
    select page_id, host, path, arg_max(rule, length(rule)) as rule,
           coalesce(arg_max(verdict, length(rule)), 'allow') as verdict
    from p left join s
      on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by page_id, host, path
    """,
)
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.counted_tokens(table(spark, sf_dir, "documents"), VOCABULARY, limit=2048)


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed(docs, VOCABULARY, capacity=4096, end_id=1, keep_ids=False)


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language.learn(docs.where(~held_out))
    return language.identified(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    scores = classifier.scored(docs, classifier.learn(docs, labels))
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted)


@query("op9_ngram_jaccard", twins.NGRAM_JACCARD)
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"), size=3, percent=90)


@query("op3_suffix_dedup", twins.SUFFIX_DEDUP)
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "tokens")
    tokenfiles.write(table(spark, sf_dir, "documents"), VOCABULARY, folder, end_id=2)
    found = tokenfiles.documents(spark, folder)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; in every document whose hash ends in 0 the words from some place on repeat a block."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", code.alias("h"), F.floor(code / 10).alias("g"))
    docs = docs.withColumn("w", F.when(F.col("h") % 10 == 0, words_of(F.col("text"))))
    docs = docs.withColumn("n", F.size("w").cast("bigint"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    docs = docs.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    block = F.slice("w", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest.cast("int"))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), tail)
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", twins.PERIODIC_RUNS)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(table(spark, sf_dir, "documents"))
    found = periods.periodic_runs(docs, min_length=24, min_repeats=3)

    def earlier(a, b):
        more, less = a.length * b.period, b.length * a.period
        key_a, key_b = F.struct(-more, a.start, a.period), F.struct(-less, b.start, b.period)
        return F.when(key_a < key_b, -1).when(key_a > key_b, 1).otherwise(0)

    found = found.withColumn("best", F.get(F.array_sort("runs", earlier), F.lit(0)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=8, scale=1024.0, shift=100_000)
