"""Encoding of a whole corpus with a public tokenizer (problem 8).

Texts are split into words once, in Spark, by the tokenizer's own pattern; each distinct word is encoded once; ids are joined back by
position. Words that make up a share of HOT or more of the corpus (by definition at most 1 / HOT of them, so what is broadcast has a
bound that no corpus exceeds) are looked up where the words are, batch by batch; the others, none of which can crowd a task, are joined
by a shuffle on the word and put in at their places. Decoding joins ids with the table of pieces.

Defined cases: null and empty texts have an empty list of ids; blank texts are encoded as they are; texts are never shortened; repeated
rows need distinct ids; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.session import cut

#: Where the vocabulary lies: an argument of every function here, by default from the environment.
TOKENIZER = os.environ.get("EDICTA_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
HOT = 1e-5
#: White space as the pattern means it; Java's own class is narrower.
_W = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Byte-level pattern of the public tokenizer (fixed value).
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_W}\p{{L}}\p{{N}}]+|[{_W}]+(?![^{_W}])|[{_W}]+"


def split(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, words): the pattern's words of each text that is not empty, in order."""
    return df.where(F.col(text) != "").select(F.col(doc_id).alias("doc"), F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0)).alias("words"))


def encoded_words(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(word, times, ids): the distinct words, each encoded once. docs: (doc, words)."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True
        for frame in frames:
            frame["ids"] = [x.ids for x in t.encode_batch(frame["word"].tolist(), add_special_tokens=False)]
            yield frame

    rows = docs.select(F.explode("words").alias("word"))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("times")).mapInPandas(encode, "word string, times long, ids array<int>")


def frequent(table: DataFrame) -> pa.Table:
    """(word, ids) of the words with a share of HOT or more: at most 1 / HOT rows."""
    total = table.agg(F.sum("times")).first()[0] or 0
    rows = table.where(F.col("times") >= max(1.0, HOT * total)).select("word", "ids").collect()
    return pa.table({"word": pa.array([r.word for r in rows], pa.string()), "ids": pa.array([list(r.ids) for r in rows], pa.list_(pa.int32()))})


def _flat(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(words, index of the document of each, words of each document) of a batch."""
    lists = batch.column("words")
    return lists.flatten(), pc.list_parent_indices(lists), pc.list_value_length(lists)


def looked_up(docs: DataFrame, hot: pa.Table) -> DataFrame:
    """(doc, ids, at, cold): the ids of a document's frequent words in order, its other words, and for each of these how many of the ids
    stand before it. Batches are looked up as columns; no word becomes an object."""
    import numpy as np

    kind = docs.schema["doc"].dataType.simpleString()
    known = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        value_set, lists = table.column("word").combine_chunks(), table.column("ids").combine_chunks()
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype("int64")
        for batch in batches:
            flat, parent, count = _flat(batch)
            at = pc.index_in(flat, value_set=value_set)
            rows, docs_of = at.to_numpy(zero_copy_only=False), parent.to_numpy(zero_copy_only=False)
            missing = np.isnan(rows) if rows.dtype.kind == "f" else np.zeros(len(rows), bool)
            picked = np.where(missing, 0, np.nan_to_num(rows)).astype("int64")
            sizes = np.where(missing, 0, size[picked] if len(size) else 0).astype("int64")
            ids = lists.take(pa.array(picked[~missing])).flatten() if len(size) else pa.array([], pa.int32())
            n = len(count)
            per_doc = np.bincount(docs_of, weights=sizes, minlength=n).astype("int64")
            starts = np.concatenate(([0], np.cumsum(per_doc)))
            before = np.cumsum(sizes) - starts[docs_of] if len(sizes) else sizes
            colds = np.concatenate(([0], np.cumsum(np.bincount(docs_of[missing], minlength=n)))).astype("int32")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids), pa.ListArray.from_arrays(pa.array(colds), pa.array(before[missing], pa.int32())), pa.ListArray.from_arrays(pa.array(colds), flat.filter(pa.array(missing)))],
                ["doc", "ids", "at", "cold"],
            )

    return docs.mapInArrow(run, f"doc {kind}, ids array<int>, at array<int>, cold array<string>")


def encode(df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, ids) of every row."""
    docs = cut(split(df, doc_id, text), "split")
    table = cut(encoded_words(docs, tokenizer), "words")
    known = cut(looked_up(docs, frequent(table)), "looked")
    # the rest by word: none of them has a share that could crowd a task
    cold = known.where(F.size("at") > 0).select("doc", F.posexplode("cold").alias("k", "word"))
    put = cold.join(table.select("word", F.col("ids").alias("piece")), "word").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("k", "piece"))).alias("put")).withColumnRenamed("doc", "_doc")
    whole = known.join(put, known.doc == put._doc, "left")
    from_, to = lambda k: F.when(k > 0, F.element_at("at", k)).otherwise(0), lambda k: F.element_at("at", k + 1)
    parts = F.transform("put", lambda p: F.concat(F.slice("ids", from_(p["k"]) + 1, to(p["k"]) - from_(p["k"])), p["piece"]))
    tail = F.slice("ids", F.element_at("at", -1) + 1, F.size("ids"))
    lists = whole.select("doc", F.when(F.size("at") == 0, F.col("ids")).otherwise(F.concat(F.flatten(parts), tail)).alias("ids"))
    rest = df.where(F.coalesce(F.col(text) == "", F.lit(True))).select(F.col(doc_id).alias("doc"), F.array().cast("array<int>").alias("ids"))
    return lists.unionByName(rest).withColumnRenamed("doc", doc_id)


def token_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens) of the rows with text: frequent words are summed up where they are, the others joined by word."""
    docs = cut(split(df, doc_id, text), "split")
    table = cut(encoded_words(docs, tokenizer), "words")
    known = cut(looked_up(docs, frequent(table)).select("doc", F.size("ids").cast("long").alias("n"), "cold"), "looked")
    cold = known.where(F.size("cold") > 0).select("doc", F.explode("cold").alias("word")).join(table.select("word", F.size("ids").cast("long").alias("n")), "word")
    return known.select("doc", "n").unionByName(cold.select("doc", "n")).groupBy("doc").agg(F.sum("n").alias("n_tokens")).withColumnRenamed("doc", doc_id)


def pieces(spark, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, hex): the bytes of each id; byte-level pieces spell bytes by printable stand-ins."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelt = {chr(b): b for b in printable}
    spelt |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    vocab = json.load(open(tokenizer, encoding="utf-8"))["model"]["vocab"]
    return spark.createDataFrame([(i, bytes(spelt[x] for x in p).hex()) for p, i in vocab.items() if all(x in spelt for x in p)], "id int, hex string")


def decode(encoded: DataFrame, doc_id: str = "doc_id", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): pieces are joined by id (a vocabulary, broadcast) and put together as bytes."""
    table = F.broadcast(pieces(encoded.sparkSession, tokenizer))
    rows = encoded.select(F.col(doc_id).alias("doc"), F.posexplode("ids").alias("pos", "id")).join(table, "id")
    text = F.decode(F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "hex"))), lambda x: x["hex"]), "")), "UTF-8")
    return rows.groupBy("doc").agg(text.alias("text")).withColumnRenamed("doc", doc_id)
