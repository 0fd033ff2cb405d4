import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamis.llm import lattice
from tamis.sources.staging import stage_scope, stage_table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block string, ids int"
TEXTS = [
    "Hello wörld, this is text.", "", None, " ", "  two  spaces ", "a\nb\n\n c", "tabs\tand\rreturns", "literal ▁ mark▁▁ x", "▁",
    "日本語 ½² ³.", "é combining", "😀🏴‍☠️", "longestword" * 40, "!" * 700, *("abcdefghij" * 100 + " " for _ in "x"), *("qu1xjumps"[i % 9 :] + "andover" * i for i in range(16, 24)),
    *("z" * n + " x" for n in (126, 127, 128, 129, 255, 256, 257, 1000)), "x y " * 30_000, "Hello wörld, this is text.", "\x00 control",
]


@pytest.fixture(scope="module")
def pieces():
    return lattice.read_pieces(MODEL)


def viterbi(word, table, longest, unknown):
    best = [(0.0, 0, 0)] + [None] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(max(0, e - longest), e):
            part = word[s:e]
            if part not in table and e - s > 1:
                continue
            i, score = table.get(part, (-1 - ord(part[0]), unknown))
            if best[e] is None or best[s][0] + score > best[e][0]:
                best[e] = (best[s][0] + score, s, i)
    ids, e = [], len(word)
    while e:
        ids.insert(0, best[e][2])
        e = best[e][1]
    return ids


def test_texts_come_back_and_paths_are_best(spark, pieces):
    rows = [(i, t, "b", 1) for i, t in enumerate(TEXTS)] + [(None, "no key", "b", 1)]
    docs = stage_table(spark.createDataFrame(rows, SCHEMA).repartition(2), "docs")
    encoded = lattice.encode(docs, MODEL)
    got = {r.doc_id: r for r in encoded.collect()}
    assert all(r.exact for r in got.values()) and len(got) == len(rows)
    table, byte_ids = {p: (i, s) for p, i, s in pieces[0]}, pieces[1]
    longest = max(map(len, table))
    unknown = min(s for _, s in table.values() if s > -1e8) - 10
    for key, text in enumerate(TEXTS):
        if len(text or "") > 2000:
            continue
        wanted = []
        for word in lattice.Cutter().words(text or ""):
            if word in (None, "\n"):
                wanted += [byte_ids[b] for b in (word or "▁").encode()]
            else:
                for i in viterbi(word, table, longest, unknown):
                    wanted += [byte_ids[b] for b in chr(-1 - i).encode()] if i < 0 else [i]
        assert list(got[key].ids) == wanted
    decoded = lattice.decode(encoded, MODEL).select("doc_id", F.col("text").alias("t"))
    assert {r.doc_id: r.t for r in decoded.collect()} == {k: t or "" for k, t, _, _ in rows}


def test_nothing_gives_nothing(spark):
    assert lattice.encode(stage_table(spark.createDataFrame([], SCHEMA), "docs"), MODEL).isEmpty()


def test_words_are_cut_where_no_piece_crosses(pieces):
    cut = lattice.Cutter()
    for text in TEXTS:
        words = cut.words(text or "")
        assert "".join("▁" if w is None else w.replace("▁", " ") for w in words)[1 if text else 0 :] == (text or "")
    assert len(pieces[1]) == 256


def test_a_block_asks_for_a_word_once(monkeypatch):
    monkeypatch.setattr(lattice, "HELD_WORDS", 3)
    texts = ["a b c d", "b c d e", None, "a e x-y " + "z" * 200, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 1, 2]), pa.array(texts)], names=["block", "text"])
    asked = [(r["block"], r["word"]) for part in lattice._asker(iter([batch, batch.slice(4)])) for r in part.to_pylist()]
    assert sorted(asked) == [*((1, w) for w in ("-", "y", "▁a", "▁b", "▁c", "▁d", "▁e", "▁x")), (2, "▁d")]


def test_words_of_most_blocks_are_common(spark):
    rows = [(b, w) for b in range(4) for w in ("all", f"own{b}")] + [(0, "two"), (1, "two"), (0, "three"), (1, "three"), (2, "three")]
    with stage_scope(spark), stage_scope(spark) as scope:
        words = lattice.asked_words(scope, spark.createDataFrame(rows, "block long, word string"))
        got = {r.word: r.blocks and sorted(r.blocks) for r in words.collect()}
    assert got == {"all": None, "three": None, "two": [0, 1], **{f"own{b}": [b] for b in range(4)}}


def test_a_word_that_went_unasked_is_folded(pieces):
    told = lattice.Assembler(*pieces)
    path = told.fold("▁unasked")
    told.learn(pa.table({"word": ["▁unasked"], "ids": pa.array([path], pa.list_(pa.int32()))}))
    assert lattice.Assembler(*pieces).encode("unasked").tolist() == told.encode("unasked").tolist() == path


def test_texts_without_words(spark):
    docs = stage_table(spark.createDataFrame([(1, None, "b", 1), (2, "", "b", 1), (3, "\n▁", "b", 1)], SCHEMA).coalesce(1), "docs")
    got = {r.doc_id: (r.n_pieces, r.exact) for r in lattice.encode(docs, MODEL).collect()}
    assert got[1] == got[2] == (0, True) and got[3][1]
