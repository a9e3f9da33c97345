"""Very long and unbroken texts, and seams in texts of any script."""

import random
import time

import numpy as np
import pytest

from relkit.llm import encoders, packing, token_counts
from relkit.llm.queries import byte_bpe


@pytest.fixture(scope="module")
def slow():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_bpe())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def unbroken():
    rnd = random.Random(1)
    return {"newlines": "\n" * 5_000_000, "spaces": " " * 5_000_000 + "end", "letters": "a" * 5_000_000,
            "drawn letters": "".join(rnd.choice("abcdefghij") for _ in range(300_000)), "mixed": ("\n" * 70_000 + "word ") * 5}


@pytest.mark.parametrize("name", unbroken())
def test_unbroken_runs_equal_the_library(slow, name):
    text = unbroken()[name]
    ids = np.concatenate(list(token_counts.spliced_ids(encoders.load(byte_bpe()), text)))
    assert ids.tolist() == slow(text)


def test_unbroken_runs_through_spark(spark, slow):
    texts = list(unbroken().values())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, byte_bpe()).collect()}
    assert counts == {k: len(slow(t)) for k, t in enumerate(texts)}
    packed = packing.pack(docs, byte_bpe()).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] - 1 for r in packed} == counts


SCRIPTS = {"Russian": "слово и дело, которые важны ", "Chinese": "漢字是書寫系統。這是一個例子，", "Arabic": "هذا نص طويل جدا ",
           "Greek": "λόγος και έργο· ", "Hindi": "यह एक वाक्य है। ", "English": "the words of a sentence, ", "Thai": "ภาษาไทย "}


@pytest.mark.parametrize("script", SCRIPTS)
def test_long_texts_of_any_script_are_cut(slow, script):
    text = SCRIPTS[script] * (1_000_000 // len(SCRIPTS[script].encode()))
    parts = list(token_counts.spliced_ids(encoders.load(byte_bpe()), text))
    assert len(parts) > 20 and np.concatenate(parts).tolist() == slow(text)


def test_proven_places_split_any_text(slow):
    """Both sides of a proven place encode by themselves, whatever the characters around it."""
    rnd = random.Random(3)
    e = encoders.load(byte_bpe())
    symbols = "ab Zé漢\U00020000٣1 '’.,;。\n\t 　́‍<|>endoftext\U0001f600ǅªⅧ\U000e0100؅Ᲊ"
    for _ in range(400):
        text = "".join(rnd.choice(symbols) for _ in range(rnd.randint(2, 60)))
        data, ids = text.encode(), slow(text)
        for at in range(1, len(data)):
            if e.proven(data, at):
                assert slow(data[:at].decode()) + slow(data[at:].decode()) == ids, (text, at)
    assert e.proven("é,".encode(), 2) and not e.proven("é|".encode(), 2) and not e.proven(b"1 ", 1)


def test_time_grows_with_the_length():
    e = encoders.load(byte_bpe())
    text = "".join(SCRIPTS.values()) * 2000
    took = []
    for t in (text, text * 4):
        began = time.perf_counter()
        token_counts.spliced_count(e, t)
        took.append(time.perf_counter() - began)
    assert took[1] < 8 * took[0]
