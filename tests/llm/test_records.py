import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tamis.llm import records

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, key string, start int"
TEXTS = [
    (5, "Don't stop, it's 42!"), (1, None), (3, ""), (3, "tie two"), (3, "tie one"), (2, "naïve ﬁne  \n\tΣΑΣ"),
    (9, "<|endoftext|> marker"), (-4, "ÀÉ ß 3²½ " * 50), (None, "no key"), (7, "x" * 5000), (5, "Don't stop, it's 42!"),
]


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, records.END_ID]


@pytest.mark.parametrize("file_bytes", [1 << 20, 60])
def test_records_come_back_in_order(spark, file_bytes):
    df = spark.createDataFrame([(*t, "k", 0) for t in TEXTS], SCHEMA).repartition(3)
    manifest = records.write_records(df, PATH, file_bytes=file_bytes)
    rows = sorted(records.read_records(manifest).collect(), key=lambda r: r.start)
    assert [r.key for r in rows] == sorted((t[0] for t in TEXTS), key=lambda k: (k is not None, k))
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    wanted = sorted((len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in (ids_of(t) for _, t in TEXTS))
    assert sorted((r.n_tokens, r.ids_crc32) for r in rows) == wanted


def test_the_index_reads_in_any_order(spark):
    df = spark.createDataFrame([(i, f"text number {i}", "k", 0) for i in range(40)], SCHEMA)
    index = records.read_index(records.write_records(df, PATH, file_bytes=300))
    assert index.select("path").distinct().count() > 1
    got = {r.key: r.ids for r in records.fetch(index.orderBy(F.rand(3))).collect()}
    assert got == {i: ids_of(f"text number {i}") for i in range(40)}


def test_runs_of_letters_are_one_word():
    texts = [t or "" for _, t in TEXTS] + ["  a\t\n b ", "Don't stop,stop I'LL ªº 7x", "İstanbul ǅ ŉ", "\x1c\x85 a\xa0b", "a  b" * 99]
    encoder = records.Encoder(PATH)
    wanted = [np.array(ids_of(t)[:-1], "<u2").tobytes() for t in texts]
    assert [encoder.encode(t) for t in texts] == wanted
    split, encoder.split = encoder.split, lambda run: pytest.fail(f"{run} is cut")
    assert encoder.encode("unheardof") == np.array(ids_of("unheardof")[:-1], "<u2").tobytes()
    encoder.split = split


@pytest.mark.parametrize("chars", [1, 1 << 22])
def test_texts_are_encoded_together(monkeypatch, chars):
    odd = ["  a\t\n b ", "stop,stop I'LL'S don'tx''s !'s", "ªº 7x¼²34", "İstanbul ǅ ŉ Ⱥb Ⱦ Ÿ", "\x1c\x85 a\xa0b", " ", "\n\n", "***\nx%%%"]
    texts = [t for _, t in TEXTS] + odd * 2
    monkeypatch.setattr(records, "PORTION_CHARS", chars)
    encoder, cut = records.Encoder(PATH), []
    wanted = [np.array(ids_of(t)[:-1], "<u2").tobytes() for t in texts]
    assert list(encoder.encode_all(pa.array(texts))) == wanted
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []
    find, encoder.cut = encoder.cut, lambda runs: cut.append(runs) or find(runs)
    assert len(list(encoder.encode_all(pa.array(["two words, two words"] * 50)))) == 50
    assert chars == 1 or cut == ["two\nwords,\nwords\n"]


def test_frequent_keys_outlive_rare_ones():
    made = []
    memo = records._Memo(lambda key: made.append(key) or key.encode(), 8)
    for i in range(100):
        assert memo["often"] == b"often" and memo[f"rare{i}"] == f"rare{i}".encode()
        assert len(memo) + len(memo.older) <= 8
    assert made.count("often") == 1


def test_damage_is_noticed():
    whole = records.frame(b"payload")
    assert records.unframe(whole) == b"payload"
    for at in range(len(whole)):
        with pytest.raises(ValueError, match="damaged"):
            records.unframe(whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1 :])


def test_no_documents(spark):
    manifest = records.write_records(spark.createDataFrame([], SCHEMA), PATH)
    assert records.read_records(manifest).isEmpty()
    assert records.read_index(manifest).isEmpty()
