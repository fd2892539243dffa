"""The registered queries ``opN_<name>``: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import chat, classifier, grammar, licences, lines, neighbours, packing, quality, secrets
from kestrel.llm import sentencepieces, simhash, trie, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file (installed on every machine)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def fertility_vocabularies() -> list[str]:
    return [vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json")]


@query
def op1_pruned_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query
def op2_line_edit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lines.drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"),
                            one_edit_chars=lines.ONE_EDIT_CHARS)
    gone = F.concat_ws(",", F.transform("removed", lambda r: F.concat_ws(
        ":", *[r[c].cast("string") for c in ("line_no", "first_doc", "first_line")])))
    return d.select("doc.doc_id", F.size("removed").cast("long").alias("n_removed"), gone.alias("removed"),
                    F.sha2("doc.text", 256).alias("kept_sha256"))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op4_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


ORACLES["op4_chat_perspectives"] = chat.ORACLE


@query
def op5_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secrets.scan(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.col("spans_text").alias("spans"),
                    "n_live", "n_example")


@query
def op6_grammar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar.read(grammar.write(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = quality.rate(table(spark, sf_dir, "documents"), fertility_vocabularies())
    return r.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "n_outside", *[c for c in r.columns if c.endswith(("_0", "_1"))])


@query
def op9_nb_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = classifier.fit(docs, labels, training=~classifier.held_out())
    return classifier.score(docs, model).select(
        "doc_id", classifier.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = sentencepieces.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return e.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        # the borders of all pieces, in a sum that any change of a span changes
        F.xxhash64("begin", "end").alias("spans_xxhash64"))


@query
def op11_licence_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score", "freedom",
        F.array_join("expressions", "; ").alias("expressions"))


@query
def op12_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))


ORACLES["op13_prefix_trie"] = trie.ORACLE
