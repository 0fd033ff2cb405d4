import math
import re

from tamis.llm import disclosure
from tamis.sources.staging import stage_table

SCHEMA = "doc_id long, text string, base string, row int, block string"


def by_pattern(text):
    """The finds as the patterns say, by plain regular expressions."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


TEXTS = [
    "a@b@c.com x.y+z@d-e.f.gh, @no.pe a@b .@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
    "+1 (555) 123-4567 ++49 30 1234567. +1 5 +123456789012345678", "é😀 a@b.de ü 10.0.0.1", "42-" * 30, "+1." * 20, "x@y.z" * 10,
]


def test_patterns_find_what_they_say():
    for text in TEXTS:
        assert disclosure.base_spans(text) == by_pattern(text)
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1" + "(" * 200_000, "a.b@" * 50_000):
        disclosure.base_spans(text)  # ends soon


def rows_of(spark, docs):
    return stage_table(spark.createDataFrame([(*d, "b", 1, "c") for d in docs], SCHEMA), "docs")


def test_words_that_disclose_an_entity(spark):
    """A rare word beside one address in three different texts gives it away; common ones do not."""
    docs = [(k, f"the memo {k} by zorro{'' if k % 2 else ','} is from chief@x.org in town {k}") for k in range(4)]
    docs += [(10 + k, f"the memo {k} is in town {k}") for k in range(40)]
    docs += [(100, "write to other@x.org about it"), (101, None), (102, ""), (3, docs[3][1]), (None, "nobody alone")]
    found = disclosure.find_spans(rows_of(spark, docs))
    got = {}
    for r in found.collect():
        text = dict(docs)[r.key] or ""
        got.setdefault(r.key, []).append({text[t.start : t.end] for t in r.terms})
    assert [len(v) for k, v in sorted(got.items(), key=lambda x: (x[0] is None, x[0] or 0)) if k == 3] == [2]
    assert all(words == {"zorro", "by", "from"} for k in range(4) for words in got[k])
    assert all(not words for k, v in got.items() if k is None or k > 4 for words in v)


def test_the_weight_is_mutual_information_over_information():
    both, entity, term, total = 4, 5, 4, 100
    share = math.log(both * total / (term * entity)) / math.log(total / entity)
    assert math.isclose(share, 1.0)


def test_sanitised_texts(spark):
    docs = [(1, "mail a@b.de, ip 10.0.0.1!"), (2, "clean"), (3, None), (4, ""), (1, "mail a@b.de, ip 10.0.0.1!"), (5, "é +49 30 1234567.")]
    df = rows_of(spark, docs)
    out = disclosure.sanitise(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        [(1, "mail [EMAIL], ip [IP]!")] * 2 + [(2, "clean"), (3, None), (4, ""), (5, "é [PHONE].")], key=repr
    )
    assert disclosure.sanitise(rows_of(spark, [])).isEmpty()
