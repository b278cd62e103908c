"""One query for each operator, on whole tables of the benchmark folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.class_model import class_scores
from millrace.llm.edits import with_counts, with_edits
from millrace.llm.histogram_shards import histogram_shards, write_shards
from millrace.llm.jaccard import near_copies
from millrace.llm.language import predict, train, training_sample
from millrace.llm.lattice import decoded, encode
from millrace.llm.manifest import proofs
from millrace.llm.manifest_sql import manifest_sql
from millrace.llm.nearest import nearest_neighbours
from millrace.llm.packing import packed
from millrace.llm.passages import repeated_passages
from millrace.llm.periodic import word_runs
from millrace.llm.phrases import edited_fingerprints
from millrace.llm.token_file import read_token_file, write_token_file
from millrace.llm.tokens import vocabulary
from millrace.sources.staging import new_location

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        _queries[name] = build
        if sql is not None:
            _sql[name] = sql
        return build

    return add


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_token_file")
def op1_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, written to token files and read back."""
    path = new_location(spark, "token-file")
    write_token_file(table(spark, folder, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return read_token_file(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op2_jaccard_join", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i:
          array_to_string(words[i:i + 3], ' '))) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met FROM e a JOIN e b USING (shingle)
           WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
          WHERE 100 * met >= 85 * (p.n_shingles + q.n_shingles - met)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION
    SELECT r.doc_id, links.y FROM r JOIN links ON links.x = r.other)
SELECT doc_id, n_shingles, min(other) AS component_id FROM n JOIN r USING (doc_id) GROUP BY doc_id, n_shingles""")
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked by a similarity of at least 0.85 over four-word shingles."""
    groups = near_copies(table(spark, folder, "documents"), words=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


@query("op3_language")
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learnt from those outside the held-out fold."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = train(training_sample(documents.where(~held_out)))
    return predict(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def edits_of(text: str = "text"):
    """Three edits of a text: its middle goes, its beginning is put in, some of it is written again."""
    n, piece = F.length(text), lambda a, size: F.substring(F.col(text), a, size)
    edit = lambda start, end, new: F.struct(
        start.cast("int").alias("start"), end.cast("int").alias("end"), new.alias("text"))
    quarter = F.floor(n / 4)
    return F.array(
        edit(2 * quarter, 2 * quarter + 40, F.lit("")), edit(quarter, quarter, piece(F.lit(1), F.lit(25))),
        edit(3 * quarter, 3 * quarter + 7, F.concat(F.lit(" "), piece((quarter + 1).cast("int"), F.lit(12)), F.lit("\n"))))


@query("op4_edit_counts")
def op4_edit_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document before and after three edits."""
    path = vocabulary("byte_bpe_50k.json")
    counted = with_counts(table(spark, folder, "documents").select("doc_id", "text"), path)
    counted = counted.withColumns({"edits": edits_of(), "n_tokens_before": F.col("n_tokens")})
    return with_edits(counted, "edits", path).select(
        "doc_id", "n_tokens_before", "n_tokens", F.length("text").alias("n_chars"), "encoded_chars")


@query("op5_lattice")
def op5_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document by the pieces' lattice, and whether they decode to its text again."""
    documents, path = table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model")
    again = F.xxhash64(decoded("ids", path)) == F.col("text_hash")
    return encode(documents, path).select(
        "doc_id", F.size("ids").alias("n_ids"), "ids", (again | (F.size("ids") == 0)).alias("round_trip"))


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(table(spark, folder, "documents"))


@query("op7_histogram_shards")
def op7_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, written in eight shards of near equal bytes and read back; equal texts together where that allows it."""
    text, path = F.col("text"), new_location(spark, "shards")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    sharded = histogram_shards(table(spark, folder, "documents"), size, text, F.col("doc_id").cast("long"))
    write_shards(sharded, path)
    return spark.read.schema(sharded.schema).parquet(path).select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query("op8_passages")
def op8_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has too."""
    return repeated_passages(table(spark, folder, "documents"))


@query("op9_nearest", """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(
          list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10""")
def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, folder, "embeddings")
    return nearest_neighbours(vectors.where("vec_id % 100 = 0"), vectors, "vec_id", "embedding", 10)


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packed(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json")).drop("ids")


@query("op11_class_scores")
def op11_class_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a class model of those outside the held-out fold."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return class_scores(table(spark, folder, "documents"), held_out)


@query("op12_word_runs")
def op12_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document's words, a tenth of the documents made periodic first."""
    return word_runs(table(spark, folder, "documents"), rewrite=True).drop("starts", "lengths", "periods")


@query("op13_manifest", manifest_sql())
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether it still leads to the root when tampered with."""
    return proofs(table(spark, folder, "documents"))
