"""Token ids against the public libraries."""

import base64

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rollweave.llm.tokens import encode_corpus, encode_texts, public_path, public_pattern

ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
LIBRARY = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
LIBRARY.encode_special_tokens = True


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("etaoins rhld'", max_size=80)), max_size=8))
def test_against_libraries(texts):
    mine = encode_texts(texts, public_path(), public_pattern())
    assert mine == [TIKTOKEN.encode_ordinary(t) for t in texts]
    assert mine == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " ", "x"), (4, "<|endoftext|> ok", "x"), (5, "ab" * 60_000, "x"), (5, "naïve\u0085​", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r["doc_id"], list(r["ids"])) for r in encode_corpus(df, "doc_id", "text").collect()), key=lambda r: (r[0], len(r[1])))
    assert got == sorted(((i, TIKTOKEN.encode_ordinary(t or "")) for i, t, _ in rows), key=lambda r: (r[0], len(r[1])))
    assert encode_corpus(df.limit(0), "doc_id", "text").collect() == []
