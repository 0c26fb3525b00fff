import random
import zlib

import numpy as np
import pytest

from punktwerk.llm import token_files
from punktwerk.llm.queries import QUERIES, tokenizer
from punktwerk.llm.tokens import TextEncoder
from punktwerk.session import scratch_path
from tests.llm.conftest import SF, edge_rows

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(11)
    bits = [" ", "  ", "\n", "\t", "a", "word", "don't", "we'll", "É", "l'été", "12", "3.4", ",", "...", "!?", " ", "\x1f", "\r\n",
            "́", "ß", "日本語", "🙂", "<|endoftext|>", "_", "-", "x.y", "A|B", "\x0b", " ", "'s", "i̇"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(400)]


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
@pytest.mark.parametrize("width", [2, 4])
def test_units_encode_like_whole_texts(name, width):
    own, whole = TextEncoder(tokenizer(name), width), library(name)
    texts = odd_texts() + [r[1] or "" for r in edge_rows()]
    for t, got in zip(texts, own.encode(texts)):
        assert np.frombuffer(got, f"<u{width}").tolist() == whole(t), repr(t[:80])


def test_memo_is_bounded():
    own, whole = TextEncoder(tokenizer(WORD_BPE), memo_units=5), library(WORD_BPE)
    for t in ("a b c d e f g h", "h g f e d c b a", "new words here"):
        assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == whole(t)
        assert len(own._memo) <= 5


def expected(rows, name, end):
    enc, at, out = library(name), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = enc(t) + [end]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files_whole_table(spark, sf_docs):
    want = expected(list(sf_docs[["doc_id", "text"]].itertuples(index=False)), WORD_BPE, 2)
    assert sorted(tuple(r) for r in QUERIES["op2_token_files"](spark, SF).collect()) == want


def test_token_files_edge_cases(edge, empty):
    got = sorted((tuple(r) for r in token_files.token_digest(edge, tokenizer(WORD_BPE), 2).collect()), key=lambda r: r[1])
    want = expected([(r[0], r[1]) for r in edge_rows()], WORD_BPE, 2)
    assert got == want          # the repeated row has equal ids, so its order doesn't show
    assert token_files.token_digest(empty, tokenizer(WORD_BPE), 2).count() == 0


def test_reads_push_predicates_to_the_files(spark, edge):
    path = token_files.write_tokens(edge, scratch_path(spark, "orc_test"), tokenizer(WORD_BPE), 2)
    one = token_files.read_tokens(spark, path, doc_ids=[13])
    assert [r.doc_id for r in one.collect()] == [13]
    assert "doc_id" in one._jdf.queryExecution().toString().split("PushedFilters")[1][:120]
    some = token_files.read_tokens(spark, path, low=10, high=20)
    assert sorted({r.doc_id for r in some.collect()}) == list(range(10, 21))


def test_files_have_bloom_filters_and_indexes(spark, edge):
    import pyarrow.orc as orc
    import glob
    path = token_files.write_tokens(edge, scratch_path(spark, "orc_meta"), tokenizer(WORD_BPE), 2)
    files = glob.glob(path.replace("file:", "") + "/*.orc")
    assert files and all(orc.ORCFile(f).row_index_stride == 1000 for f in files)


def test_end_position_of_every_file(spark, edge):
    path = token_files.write_tokens(edge, scratch_path(spark, "orc_pos"), tokenizer(WORD_BPE), 2)
    rows = token_files.read_tokens(spark, path)
    assert rows.selectExpr("sum(n_tokens) as n").first().n == rows.selectExpr("sum(size(ids)) as n").first().n


def plain_library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer(name))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def special_texts():
    """Strings of added tokens among words, folded ones and broken ones."""
    words = ["<|endoftext|>", "<|startoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|endoftext|><|endoftext|>", "<|", "word", "\u00c9t\u00e9", " ", "\n", "\t"]
    rng = random.Random(3)
    return ["x <|endoftext|> y"] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(200)] + odd_texts()


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_special_strings_like_the_plain_call(name):
    own, plain = TextEncoder(tokenizer(name), special_as_text=False), plain_library(name)
    texts = special_texts()
    for t, got in zip(texts, own.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == plain(t), repr(t[:80])


def test_operators_use_the_plain_call(spark):
    from punktwerk.llm import packing
    texts = special_texts()[:8]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name, end, digest in ((WORD_BPE, 2, token_files.token_digest), (BYTE_BPE, 1, packing.pieces)):
        plain, text_too = plain_library(name), library(name)
        field = "n_tokens" if digest is token_files.token_digest else "doc_tokens"
        for options, enc in (({}, plain), ({"special_as_text": True}, text_too)):
            got = {r.doc_id: r[field] for r in digest(docs, tokenizer(name), end, **options).collect()}
            assert got == {i: len(enc(t)) + 1 for i, t in enumerate(texts)}
        assert len(plain(texts[0])) < len(text_too(texts[0]))
