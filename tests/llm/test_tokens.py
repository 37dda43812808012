import random
from pathlib import Path

import public_tokenizers
import pytest

import __spark_entry__ as entry
from clearwell.llm.tokens import PieceCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False))


def test_pieces_add_up(whole):
    counter = PieceCounter(Path(PATH).read_text())
    for code in [*range(0x500), *range(0x500, 0x1F000, 61)]:
        if not 0xD800 <= code < 0xE000:
            c = chr(code)
            text = f"a{c}b {c} {c}{c}1 \n{c} '{c}s  "
            assert counter.count(text) == whole(text), hex(code)


def messy(rng, n):
    parts = ["word", " ", "  ", "\n", "\t ", "'s", "'", "42", "!?", "é", "漢字", "<|endoftext|>", "<|endo", "|>", "😀", " x"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_spliced_chunks_equal_the_whole(spark, whole):
    rng = random.Random(3)
    texts = [messy(rng, rng.randint(1, 400)) for _ in range(60)]
    texts += ["a" * 3000, " " * 2500, "x" * 900 + " " * 700 + "y" * 900, "<|endoftext|>" * 150, "ab " * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in count_tokens(df, PATH, chunk_chars=60, overlap_chars=24).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert (got[i]["n_tokens"], got[i]["n_bytes"]) == (whole(t), len(t.encode())), (i, t[:80])


def test_awkward_rows(spark, docs, no_docs, whole):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = count_tokens(docs, PATH, limit=30).collect()
    want = sorted(((i, len((t or "").encode()), whole(t or ""), whole(t or "") > 30) for i, t in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert count_tokens(no_docs, PATH).count() == 0


def test_query_counts_whole_texts(spark, whole):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = entry.queries()["op7_token_counts"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["over_limit"]) for r in got} == {i: (whole(t), whole(t) > 512) for i, t in texts.items()}
