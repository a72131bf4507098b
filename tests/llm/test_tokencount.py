import random

from public_tokenizers import path
from tokenizers import Tokenizer

from gridloom.llm.tokencount import PLAIN, count_tokens, whole_tokens

PATH = path("word_bpe_49k.json")


def expected(texts):
    tok = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts():
    rng = random.Random(3)
    texts = [
        None, "", " ", "The the THE", "don't they'll I'D", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>c",
        "<|endoftext", "étude É ß ẞ İstanbul ǅ", "x\x1cy\x85z w　q​z", "12345 ½ Ⅷ ²", "漢字かな 🙂👍🏽",
        "­soft­hyphen", "a" * 5000, "!!!!???;;;", "l'été – “ok” … €5", "\x00\x07", "ſ K Å", "x²³¹ ¼½¾ ªµº ×÷ Ÿÿ ŉ’s o'LL_a__b 0x1F", "İ ı",
    ]
    letters = "abcdefghij KLMéèüñß'’.,;!?0123456789\n\t-–“”<>|#$́ 漢"
    texts += ["".join(rng.choices(letters, k=rng.randint(1, 300))) for _ in range(300)]
    return texts


def test_equals_the_library_on_odd_texts(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in count_tokens(df, PATH).collect()}
    assert [got[k].n_tokens for k in range(len(texts))] == expected(texts)
    assert [got[k].n_bytes for k in range(len(texts))] == [len((t or "").encode()) for t in texts]


def test_every_plain_character_splits_as_in_the_library(spark):
    chars = [c for c in map(chr, [*range(0x180), *map(ord, "–—‘’“”…€")]) if PLAIN.fullmatch(c)]
    assert len(chars) > 300
    texts = [f"a{c}1 {c}{c}b{c} '{c}s" for c in chars] + ["".join(chars), " ".join(chars)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, PATH).collect()}
    assert [got[k] for k in range(len(texts))] == expected(texts)


def test_equals_the_library_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    got = {r.doc_id: r for r in count_tokens(docs, PATH).collect()}
    assert [got[r.doc_id].n_tokens for r in rows] == expected([r.text for r in rows])
    assert all(got[r.doc_id].over_limit == (got[r.doc_id].n_tokens > 2048) for r in rows)
    assert sum(r.n_whole for r in got.values()) > 0.2 * sum(r.n_tokens for r in got.values())


def test_whole_tokens_are_single(spark):
    whole = sorted(whole_tokens(PATH))
    assert len(whole) > 20_000 and set(expected(whole)) == {1}


def test_null_and_repeated_ids_and_extra_columns(spark):
    df = spark.createDataFrame(
        [(None, "one two", 5), (1, "one", None), (1, "one", 6), (2, None, 7)], "doc_id long, text string, n_tokens int"
    )
    got = sorted((repr(r.doc_id), r.n_tokens) for r in count_tokens(df, PATH).collect())
    assert got == [("1", 1), ("1", 1), ("2", 0), ("None", 2)]


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
