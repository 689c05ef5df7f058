"""Token counts against the tokenizers themselves."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from docketloom.llm import tokencount

PATH = "/opt/tokenizers/piece_bpe_32k.model"
ODD = ["", " ", "  ", "a", " a  b ", "\n", "x\ny  z", "日本語 テスト", "😀😀 a😀", "▁▁a▁", "naïve façade", "<s> <unk> <0x41> </s>", "a" * 5000, "ab" * 3000, "    " * 300 + "x", "é́", "\t\t", "hello   world  ", "\x00a", "�"]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_the_tokenizer_of_the_file_on_all_documents(spark, pieces):
    counter = tokencount.counter_for(PATH)
    assert isinstance(counter, tokencount.MergeCounter) and counter.by_word
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()] + ODD
    assert [counter.count(t) for t in texts] == [len(x) for x in pieces.encode(texts, num_threads=1)]


def brute_force_merges(scores, text):
    """All of a text's merges, the best score and then the leftmost place first."""
    parts = list(text)
    while True:
        found = [(-scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in scores]
        if not found:
            return parts
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_merges_with_ties_and_unreachable_pieces(byte_fallback):
    rnd = random.Random(5)
    for k in range(60):
        vocab = {"".join(rnd.choice("ab▁c") for _ in range(rnd.randint(1, 4))): float(-rnd.randint(1, 3 if k % 2 else 99)) for _ in range(14)}
        counter = tokencount.MergeCounter(list(vocab.items()), byte_fallback)
        for _ in range(40):
            text = "▁" + "".join(rnd.choice("aabbcé▁") for _ in range(rnd.randint(1, 25)))
            parts = brute_force_merges(vocab, text)
            unknown = [p not in vocab for p in parts]
            want = sum(len(p.encode()) if byte_fallback and u else 0 if u and before else 1 for p, u, before in zip(parts, unknown, [False, *unknown], strict=False))
            assert counter.count(text) == counter.search(text) == want, (vocab, text)


def unigram(vocab, byte_fallback=True):
    t = Tokenizer(models.Unigram(vocab, 0, byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(tokencount.SPACE, "always", False)
    return t


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_unigram_ties_and_real_scores(byte_fallback):
    rnd = random.Random(3)
    for k in range(30):
        some = {"".join(rnd.choice("ab▁c") for _ in range(rnd.randint(1, 4))) for _ in range(12)}
        scores = [-1, -2, -2, -3] if k % 2 else [-1.1, -2.2, -3.3, -0.7]
        vocab = [("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256) if byte_fallback], *[(p, float(rnd.choice(scores))) for p in sorted(some)]]
        counter, exact = tokencount.UnigramCounter(vocab, byte_fallback), unigram(vocab, byte_fallback)
        for _ in range(40):
            text = "".join(rnd.choice("aabbc d") for _ in range(rnd.randint(1, 25)))
            assert counter.count(text) == len(exact.encode(text, add_special_tokens=False).ids), (vocab, text)


def message(*fields):
    """Fields (number, integer or bytes) of a protocol buffer message of short values."""
    return b"".join(bytes([n << 3, v]) if isinstance(v, int) else bytes([n << 3 | 2, len(v)]) + v for n, v in fields)


def test_files_are_counted_by_their_own_kind_or_refused(tmp_path):
    def file(model, *normal, kind=1):
        (tmp_path / "m").write_bytes(message((1, message((1, b"a"), (3, kind))), (2, bytes([3 << 3, model])), (3, message(*normal))))
        return str(tmp_path / "m")

    assert isinstance(tokencount.counter_for(file(1, (4, 0))), tokencount.UnigramCounter)
    assert isinstance(tokencount.counter_for(file(2, (4, 0))), tokencount.MergeCounter)
    assert tokencount.counter_for(file(1, (4, 0), kind=3)).vocabulary == []
    with pytest.raises(ValueError, match="can't be counted"):
        tokencount.counter_for(file(3, (4, 0)))
    for normal, kind in ((((2, b"map"), (4, 0)), 1), (((4, 1),), 1), (((4, 0),), 4)):
        with pytest.raises(ValueError, match="can't be counted"):
            tokencount.counter_for(file(2, *normal, kind=kind))


def test_table(spark, pieces):
    counter = tokencount.counter_for(PATH)
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "hello world", 7), (3, "hello world", 7), (4, "word " * 50_000, 7), (None, "x" * 100_000, 7)], "doc_id long, text string, n_tokens int")
    out = [r[0] for r in df.select(tokencount.token_count(counter, F.col("text"))).collect()]
    assert out == [0, 0] + [len(pieces.encode(t)) for t in ("hello world", "hello world", "word " * 50_000, "x" * 100_000)]
    assert df.where("false").select(tokencount.token_count(counter, F.col("text"))).count() == 0
