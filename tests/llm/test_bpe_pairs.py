import hashlib

from public_tokenizers import path
from tokenizers import Tokenizer

from corpusloom.llm.bpe_pairs import bpe_decode, bpe_encode, model, op5_bpe_pairs

from .conftest import DATA

FILE = path("word_bpe_49k.json")
HARD = [
    "", " ", "\n\t", "it's you're WE'LL aaa aaaa aaaaaaa", "éclair ÉCLAIR İstanbul ΣΑΣ straße ǅ", "a<|endoftext|>b <|startoftext|>", "<|endoftext| >", " x y\u0085z\x1ca",
    "12345 x2² ١٢ Ⅷ", "中文 한국 \U0001f600\U0001f468‍\U0001f469", "\u0000\u0001 á́ ﬁ Å", "a" * 3000, "'S 'T '''s don''t",
]


def expected(texts):
    tok = Tokenizer.from_file(FILE)
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)], tok


def test_ids_equal_the_library():
    got = [model(FILE).encode(t) for t in HARD]
    assert got == expected(HARD)[0]


def test_query_equals_the_library_on_whole_texts(spark):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    ids, tok = expected(list(rows.values()))
    want = {}
    for d, x in zip(rows, ids, strict=True):
        said = tok.decode(x, skip_special_tokens=False)
        want[d] = (len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op5_bpe_pairs(spark, DATA).collect()}
    assert got == want


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "a b", "y"), (None, "a b", "z"), (2, "", "w")], "doc_id long, text string, ids string")
    got = sorted((r.doc_id or -1, r.n_tokens, r.decoded) for r in bpe_encode(df, FILE).collect())
    assert got == [(-1, 2, "a</w> b</w>"), (1, 0, ""), (1, 2, "a</w> b</w>"), (2, 0, "")]
    assert bpe_encode(df.limit(0), FILE).count() == 0
    back = bpe_decode(spark.createDataFrame([(1, None), (2, [320, 99999])], "doc_id long, ids array<int>"), FILE).collect()
    assert [r.decoded for r in back] == ["", "a</w>"]
