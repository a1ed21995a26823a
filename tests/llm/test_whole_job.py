"""Methods that must act on the whole table, against brute force."""

import re
from collections import defaultdict

from tidewatch.llm import quality_rules, unit_dedup

SF = "/root/testdata/sf0.001"


def word(i):
    return "".join(chr(97 + i // 26 ** k % 26) for k in range(4))


def brute_quality(rows, min_docs):
    """n_removed by row: lines of a host that ``min_docs`` of its distinct texts have."""
    def lines(text):
        flat = re.sub("[0-9]+", "0", re.sub(r"[\x20\x09\x0B-\x0D]+", " ", (text or "").lower()))
        return [x for x in (y.strip(" ") for y in flat.split("\n")) if x]

    texts, first = defaultdict(set), {}
    for doc_id, text, host in rows:
        for x in set(lines(text)):
            texts[host, x].add(text)
            first[host, x] = min(doc_id, first.get((host, x), doc_id))
    return [sum(len(x.split(" ")) for x in lines(text) if len(texts[host, x]) >= min_docs and first[host, x] != doc_id)
            for doc_id, text, host in rows]


def test_quality_lines_of_few_of_a_hosts_documents(spark):
    # 25 of 400 documents (6%) share two lines; for the last five these are most of the text
    rows, shared = [], " ".join(word(20000 + j) for j in range(21))
    for i in range(400):
        own = " ".join(word(i * 40 + j) for j in range(30 if i < 395 else 8))
        rows.append((i, own + (f"\nRead more  on page 3\n {shared}" if i >= 375 else ""), "h"))
    rows.append(rows[-1])  # a repeated row is judged by itself and counted once
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted((r.doc_id, r.quality.n_removed, r.quality.kept) for r in quality_rules.judge(df).collect())
    gone = brute_quality(rows, 20)
    assert [x[1] for x in got] == gone and gone[375] == 0 and gone[376] == gone[-1] == 26
    assert [x[0] for x in got if not x[2]] == [395, 396, 397, 398, 399, 399]


def test_quality_lines_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for min_docs in (2, 3):
        want = dict(zip((r[0] for r in rows), brute_quality(rows, min_docs), strict=True))
        got = {r.doc_id: r.quality for r in quality_rules.judge(docs, min_docs=min_docs).collect()}
        assert {d: q.n_removed for d, q in got.items()} == want and any(want.values())
        assert all(q.kept == (not q.base_failed and not (q.n_removed and q.n_words - q.n_removed < q.n_words * 0.5))
                   for q in got.values())


def test_units_inside_longer_sentences(spark):
    # passages of 60 words without a stop, inside sentences that differ on both sides
    rows, inside = [], {}
    for i in range(40):
        passage = " ".join(word(9000 + i * 60 + j) for j in range(60))
        for k in (0, 1):
            before, after = (" ".join(word(50000 + (2 * i + k) * 20 + j) for j in range(a, a + 10)) for a in (0, 10))
            rows.append((100 * k + i, f"{before} {passage} {after}."))
            inside[100 * k + i] = (len(before), len(before) + 1 + len(passage))
    runs = unit_dedup.repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert all(inside[r.doc_id][0] <= r.start and r.end <= inside[r.doc_id][1] for r in runs)
    assert {r.first_doc_id for r in runs} == {r.doc_id - 100 for r in runs} and len({r.doc_id for r in runs}) >= 36


def test_units_of_texts_that_share_an_id(spark):
    opening = " ".join(f"Opening sentence number {word(i)} of this page has a few words." for i in range(5))
    rows = [(i, f"{opening}\n{word(i or 0)} {word(900 + k)}") for i in (None, 7) for k in range(3)]
    runs = unit_dedup.repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    # one of the three texts with a null id keeps the opening
    assert sorted((r.doc_id is not None, r.start, r.end) for r in runs) == sorted(
        [(False, 0, len(opening))] * 2 + [(True, 0, len(opening))] * 3)


def test_quality_removes_the_lines(spark):
    # depletion decides for some documents; the others lose exactly the counted words
    shared = [" ".join(word(20000 + 50 * k + j) for j in range(12)) for k in range(3)]
    rows = []
    for i in range(60):
        own = [" ".join(word(i * 90 + 30 * k + j) for j in range(20 if i < 50 else 4)) for k in range(2)]
        rows.append((i, f"{own[0]}\n\n  {shared[0]} 12\n{own[1]}\r\n{shared[2]}  7\n\t{shared[1].upper()}\n", "h"))
    rows += [(70, None, "h"), (71, "", "h"), (72, "\n\n", None), (73, " ".join(["x" + word(j) for j in range(30)]), None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 AS numbers", "2 AS gone")
    verdict = {r.doc_id: r.quality for r in quality_rules.judge(df).collect()}
    kept = {r.doc_id: r for r in quality_rules.reject(df).collect()}
    assert set(kept) == {i for i, q in verdict.items() if q.kept} and set(kept) == {*range(50), 73}
    assert not any(verdict[i].base_failed for i in range(50, 60)) and all(verdict[i].n_removed for i in range(1, 60))
    before = {r[0]: r[1] for r in rows}
    assert kept[0].text == before[0] and kept[73].text == before[73]  # the first keeps the lines
    for i in range(1, 50):
        lines = before[i].split("\n")
        assert kept[i].text == "\n".join([lines[0], lines[1], lines[3], lines[6]])
        assert len(before[i].split()) - len(kept[i].text.split()) == verdict[i].n_removed
        assert (kept[i].numbers, kept[i].gone) == (1, 2)
