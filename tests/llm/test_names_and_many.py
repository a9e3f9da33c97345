"""Inputs with the names that operators use themselves, and with very many languages."""

import random

import pytest
from pyspark.sql import functions as F

from relkit.llm import byte_pairs, centroids, decontaminate, fingerprints, language, lexical, licenses, near_dedup, packing, secrets
from relkit.llm import token_counts
from relkit.llm.queries import byte_bpe

TAKEN = ("_t1", "_t2", "_letters", "_row", "_key", "t1", "t2", "row", "id", "_text", "base", "tokens", "spans", "_all", "_clean", "n", "k",
         "piece", "length", "_salt", "share", "l", "cls", "key", "path", "term", "terms")


@pytest.fixture(scope="module")
def taken(spark):
    rnd = random.Random(1)
    text = lambda: " ".join(f"w{rnd.randrange(300)}" for _ in range(60))
    one = text()
    rows = [(1, one, "en", "s", 9), (2, one, "en", "s", 9), (3, text(), "de", "s", 9), (4, None, None, "s", 9), (5, "12", "en", "s", 9),
            (6, text() + " " + one, "fr", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(f"x{k}") for k, c in enumerate(TAKEN)})


def test_stages_keep_all_columns(spark, taken):
    bench = spark.createDataFrame([(1, taken.first().text, "y")], "item_id long, text string, t1 string")
    for out, n in ((language.keep_identified(taken, language.learn(taken)), 4), (near_dedup.drop_near_duplicates(taken), 5),
                   (decontaminate.drop_contaminated(taken, bench), 3), (secrets.redact_secrets(taken), 6)):
        assert out.columns == taken.columns
        rows = out.collect()
        assert len(rows) == n and all(r[c] == f"x{k}" for r in rows for k, c in enumerate(TAKEN))


def test_operators_ignore_all_columns(spark, taken):
    import public_tokenizers
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    for out in (secrets.scan_secrets(taken), token_counts.token_counts(taken, byte_bpe()), near_dedup.near_duplicates(taken),
                decontaminate.flag_documents(taken, taken.withColumn("item_id", F.col("doc_id"))), fingerprints.next_edits(taken),
                language.identify(taken, language.learn(taken)), byte_pairs.digests(taken, ranks, pattern)):
        assert out.count() == 6
    assert packing.pack(taken, byte_bpe()).count() >= 6
    assert licenses.scan_licenses(taken.withColumn("path", F.concat(F.lit("a/"), F.col("doc_id").cast("string")))).count() == 6
    assert lexical.ranked_search(taken, taken.withColumn("item_id", F.col("doc_id"))).count() > 0
    vectors = taken.withColumns({"vec_id": F.col("doc_id"), "embedding": F.array(*[F.lit(float(k)) for k in range(64)])})
    assert centroids.cluster(vectors)[0].count() == 6


def test_very_many_languages(spark):
    rows = [(k, f"wort{k} {chr(97 + k % 26) * 5} {k * 7919}", f"lang{k:05d}") for k in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.learn(docs)
    assert 7_500 < len(model.langs) < 8_500  # the held-out fifth teaches nothing
    seen = docs.where(~language.held_out(F.col("doc_id"))).orderBy("doc_id").limit(20)
    got = language.identify(seen, model).join(seen.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 20 and sum(r.lang_pred == r.lang for r in got) >= 18
