import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tamis.llm import curve_packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, sequence_id string, at int"


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, curve_packing.END_ID]


def check_layout(rows, length):
    """Every sequence is gapless; all are full, but for the last ones, which fall by powers of two."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    sizes = []
    for k in sorted(sequences):
        at = 0
        for offset, n in sorted(sequences[k]):
            assert offset == at and n > 0
            at += n
        sizes.append(at)
    short = [n for n in sizes if n != length]
    assert sizes == [length] * (len(sizes) - len(short)) + short
    assert all(n & (n - 1) == 0 for n in short) and short == sorted(set(short), reverse=True)


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_all_cells_step_by_step(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    index = curve_packing.hilbert(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.mark.parametrize("total", [0, 1, 7, 8, 9, 23, 8 * 5 + 7])
def test_borders_leave_no_padding(total):
    whole, ends = curve_packing.borders(total, 8)
    assert whole == total // 8 * 8 and (ends[-1] if ends else whole) == total
    sizes = np.diff([whole, *ends]).tolist()
    assert all(n & (n - 1) == 0 for n in sizes) and sizes == sorted(set(sizes), reverse=True)


@pytest.mark.parametrize("length", [64, 2048])
def test_pieces_make_up_the_documents(spark, length):
    rng = random.Random(length)
    rows = [(k, " ".join(rng.choice("one two three four five six".split()) for _ in range(rng.randrange(300)))) for k in range(60)]
    rows += [(5, None), (None, "no key"), (7, ""), (7, ""), (100, "x y " * 3000), (-3, "naïve ÀÉ"), (8, rows[8][1])]
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], SCHEMA).repartition(3)
    found = curve_packing.pack(df, PATH, length=length).collect()
    check_layout(found, length)
    texts = defaultdict(list)
    for r in found:
        texts[r.doc_id].append((r.start, r.length, r.doc_tokens, np.frombuffer(r.ids, "<u2").tolist()))
    wanted = defaultdict(list)
    for k, t in rows:
        wanted[k].append(ids_of(t))
    for k, whole in wanted.items():
        assert all(n == len(ids) for _, n, _, ids in texts[k])
        if len(whole) == 1:
            joined = [i for _, _, _, ids in sorted(texts[k]) for i in ids]
            assert joined == whole[0] and {n for _, _, n, _ in texts[k]} == {len(whole[0])}
        assert sum(n for _, n, _, _ in texts[k]) == sum(map(len, whole))


def test_copies_and_near_copies_are_neighbours(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("ana", "elo", "iru", "ote", "unda")]
    rows = []
    for k in range(150):
        words = rng.sample(vocabulary, 30) * 3
        rows += [(k, " ".join(words)), (1000 + k, " ".join([*words[:-1], "zebra"]))]
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], SCHEMA)
    found = curve_packing.pack(df, PATH).collect()
    place = {r.doc_id: (r.sequence_id, r.offset) for r in found if r.start == 0}
    order = {k: i for i, k in enumerate(sorted(place, key=place.get))}
    apart = [abs(order[k] - order[1000 + k]) for k in range(150)]
    assert sorted(apart)[75] <= 5  # 100 by chance


def test_no_documents(spark):
    pieces = curve_packing.pack(spark.createDataFrame([], SCHEMA), PATH)
    assert pieces.isEmpty() and curve_packing.checksums(pieces).isEmpty()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op12_curve_packing"](spark, sf).collect()
    check_layout(found, 2048)
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert set(pieces) == {d.doc_id for d in docs}
    for doc in docs:
        ids, at = ids_of(doc.text), 0
        for r in sorted(pieces[doc.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
