"""The operators on small tables: edge rows, clashing columns, brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import (bpe_codec, chat_format, decontaminate, lang_id, pii, quality_rules, queries, simhash,
                           token_counts, token_output, unit_dedup)
from tidewatch.session import scratch_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "long words here again " * 30000
EDGE = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, LONG, "en", "s", 1), (4, LONG, "fr", "s", 1),
        (4, LONG, "fr", "s", 1), (None, "a null id with some words in it", "en", None, 2), (5, "   \n ", None, "s", 3),
        (6, "one", "de", "s", 3), (7, "漢字 😀 " * 30, None, "s", 3)]


@pytest.fixture(scope="module")
def edge(spark):
    # columns that clash with names the operators work with
    return spark.createDataFrame(EDGE, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("spans", "quality", "fp", "row", "k1", "_t", "base", "cuts", "n_tokens", "c0")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def test_counts_codec_and_ids_on_edge_rows(spark, edge, empty):
    path = queries.vocabulary()
    coded = {(r.doc_id, r.n_tokens) for r in bpe_codec.encode_decode(edge, path).collect()}
    counted = token_counts.count_tokens(edge, path, 2048).collect()
    assert {(r.doc_id, r.n_tokens) for r in counted} == coded and len(counted) == len(EDGE)
    assert {r.doc_id: r.n_bytes for r in counted}[1] == 0
    out = scratch_path(spark, "ids")
    token_output.write_ids(edge, out, path, 2, parts=3)
    rows = token_output.id_digests(token_output.read_ids(spark, out)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6, 7]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert {(r.doc_id, r.n_tokens - 1) for r in rows} == coded
    assert [r.doc_id for r in token_output.lookup(spark, out, [6]).collect()] == [6]
    for df in (bpe_codec.encode_decode(empty, path), token_counts.count_tokens(empty, path, 1)):
        assert df.count() == 0
    token_output.write_ids(empty, out + "e", path, 2)
    assert token_output.read_ids(spark, out + "e").count() == 0


def test_orc_files_hold_ranges_and_bloom_filters(spark, docs):
    out = scratch_path(spark, "ids")
    token_output.write_ids(docs, out, queries.vocabulary(), 2, parts=4)
    spans = spark.read.orc(out).groupBy("part").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).orderBy("a").collect()
    assert len(spans) == 4 and all(x.b < y.a for x, y in zip(spans, spans[1:]))
    plan = token_output.lookup(spark, out, [3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(doc_id" in plan


def test_chat_contract(spark):
    rows = {r.conv_id: r for r in queries.op1_chat_format(spark, SF).collect()}
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(rows) == set(turns)
    for k, ts in turns.items():
        loss = "".join(t for role, t in ts if role == "assistant")
        assert rows[k].n_turns == len(ts) and rows[k].loss_chars == len(loss)
        assert rows[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest()
        assert rows[k].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_edge_rows(spark):
    rows = [(1, 0, None, None), (1, None, "user", "x"), (None, 0, "[AS] ", LONG), (1, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segment", F.lit(1))
    made = chat_format.format_conversations(df)
    got = {r.conv_id: r.n_turns for r in chat_format.read_back(made).collect()}
    assert got == {1: 3, None: 1}
    assert chat_format.read_back(made.filter("false")).count() == 0


def test_language_accuracy_and_edges(spark, docs, edge, empty):
    model = lang_id.train(docs.filter(~lang_id.held_out()))
    got = lang_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right / n >= 0.9
    told = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.predict(edge, model).collect()}
    assert told[1] == told[2] == told[5] == ("und", 0.0) and all(0 <= s <= 1 for _, s in told.values())
    assert lang_id.predict(empty, lang_id.train(empty)).count() == 0
    one = lang_id.train(spark.createDataFrame([(1, "abc", "xx")], "doc_id bigint, text string, lang string"))
    assert {r.lang_pred for r in lang_id.predict(edge, one).filter("doc_id in (3, 7)").collect()} == {"xx"}


def test_units_keep_the_first_and_remove_the_rest(spark, edge, empty):
    passage = " ".join(f"Sentence number {i} has words." for i in range(12))
    rows = [(1, f"alpha beta. {passage} tail one", "en"), (2, f"gamma\n{passage}\ndelta", "en"), (3, "gamma", "en"),
            (4, f"Short. {passage[:40]} Short.", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, cleaned string")
    runs = unit_dedup.repeats(df).collect()
    assert [(r.doc_id, r.first_doc_id) for r in runs] == [(2, 1)]
    text = rows[1][1]
    assert text[runs[0].start:runs[0].end] == passage
    cleaned = {r.doc_id: r.text for r in unit_dedup.remove(df, unit_dedup.repeats(df)).collect()}
    assert cleaned == {1: rows[0][1], 2: "gamma\n\ndelta", 3: "gamma", 4: rows[3][1]}
    out = unit_dedup.remove(edge, unit_dedup.repeats(edge))
    assert out.columns == edge.columns and out.count() == len(EDGE)
    assert unit_dedup.repeats(empty).count() == 0


def test_units_against_brute_force(spark, docs):
    first, all_units = {}, {}
    for r in docs.orderBy("doc_id").collect():
        all_units[r.doc_id] = unit_dedup.units(r.text)
        for a, _, _, norm in all_units[r.doc_id]:
            first.setdefault(norm, (r.doc_id, a))
    want = set()
    for d, us in all_units.items():
        run = []
        for u in [*us, None]:
            if u and first[u[3]] != (d, u[0]):
                run.append(u)
                continue
            if sum(x[2] for x in run) >= 25:
                want.add((d, run[0][0], run[-1][1]))
            run = []
    assert {(r.doc_id, r.start, r.end) for r in unit_dedup.repeats(docs).collect()} == want


def test_quality_lines(spark, edge, empty):
    name = lambda i, j: chr(97 + i // 8) + chr(97 + i % 8) + chr(97 + j)
    words = [" ".join(name(i, j) for j in range(25)) for i in range(60)]
    rows = [(i, f"{w}\nSubscribe to   OUR letter {i}", "h") for i, w in enumerate(words)]
    rows += [(100 + i, "subscribe to our letter 7\n" + " ".join(name(i + 70, j) for j in range(2)) + "\nsubscribe to our letter 8 " * 5, "h")
             for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r.quality for r in quality_rules.judge(df, min_words=6).collect()}
    assert got[0].n_removed == 0 and got[1].n_removed == 5 and got[59].kept
    assert {r.doc_id for r in quality_rules.reject(df, min_words=6, min_left=0.9).collect()} == {0}
    out = quality_rules.reject(edge)
    assert out.columns == edge.columns
    judged = quality_rules.judge(edge)
    assert judged.columns[-1] == "_quality" and judged.count() == len(EDGE)
    assert quality_rules.judge(empty).count() == 0


def test_quality_base_against_brute_force(spark, docs):
    for r in quality_rules.judge(docs).collect():
        w, q = re.findall(r"[^\x20\x09-\x0D]+", r.text), r.quality
        seen, covered = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7)), set()
        for i in range(len(w) - 7):
            if seen[tuple(w[i:i + 8])] > 1:
                covered.update(range(i, i + 8))
        lines = [x for x in r.text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text)), len(lines) - len(set(lines)), len(covered))


def brute_components(rows):
    fps = {d: f for d, f in rows}
    root = {d: d for d in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_simhash_components(spark, docs, edge, empty):
    base = "the quick brown fox jumps over the lazy dog while it rains on the old stone bridge near town "
    extra = [(1000 + i, base * 6 + " ".join(f"v{i}" for _ in range(i % 5)), "en", "s", 0) for i in range(40)]
    df = docs.unionByName(spark.createDataFrame(extra, SCHEMA)).unionByName(
        spark.createDataFrame([(2000, None, "en", "s", 0), (2001, " ", "en", "s", 0)], SCHEMA))
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(df).collect()}
    want = brute_components((d, f) for d, (f, _) in got.items())
    assert {d: c for d, (_, c) in got.items()} == want and got[2000] == got[2001] == (0, 2000)
    kept = simhash.keep_first(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == df.columns
    assert simhash.near_duplicates(edge).count() == len(EDGE)
    kept = simhash.keep_first(edge)
    assert kept.columns == edge.columns and kept.filter("doc_id = 4").count() == 0  # a copy of 3
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def confirmed(kind, m):
    d = [int(c) for c in m if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        folded = [x * (1 + i % 2) for i, x in enumerate(reversed(d))]
        return 12 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in folded) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def plain_spans(text):
    found = [(m.start(), k, name, m.end()) for k, (name, p) in enumerate(PATTERNS)
             for m in re.finditer(p, text) if confirmed(name, m[0])]
    return ",".join(f"{n}:{a}:{b}" for a, _, n, b in sorted(found))


def test_personal_data(spark, edge, empty):
    texts = ["a@b.com%x@y.org", "😀 me.x@mail.example.com, +1 (499) 555-6503.", "4432507379035540 and 1.2.3.4.5.6.7.8 256.1.1.1",
             "000000000000000000000000255.1.1.1", "1" * 5000, "1 " * 5000, "a" * 20000, "a@" * 3000, "1.2.3.4 " * 700, "+1 " * 99,
             "+12345678 +123456789", "IBAN GB82 WEST 1234 5698 7654 32 or GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789 x",
             "ref 123-45-6789 x", 'token = "1eb9c654e721b4f8aa"', None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.find(df).select("doc_id", pii.spans_text(F.col("spans"), True).alias("base"),
                                                    pii.spans_text(F.col("spans")).alias("all")).collect()}
    for i, t in enumerate(texts):
        assert got[i].base == plain_spans(t or ""), t[:50]
    assert got[11].all == "iban:5:32" and got[12].all == "ssn:4:15" and got[13].all == ""
    assert got[14].all.startswith("secret:6:")
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[1] == "😀 [EMAIL], [PHONE]." and clean[15] is None and clean[16] == "" and clean[4] == "1" * 5000
    out = pii.redact(edge)
    assert out.columns == edge.columns and out.count() == len(EDGE)
    assert pii.find(empty).count() == 0


def test_leaks_against_brute_force(spark, docs, bench, edge, empty):
    items = bench.collect()
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in items if b.text in d.text}
    found = decontaminate.matches(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(want & got) >= 0.9 * len(want)  # recall of the search
    def share(text, b):
        p = decontaminate.Passage(0, decontaminate.word_hashes(b)[:60], frozenset())
        return decontaminate.common_length(p.masks, len(p.words), decontaminate.word_hashes(text).tolist()) / len(p.words)
    text, item = {d.doc_id: d.text for d in docs.collect()}, {b.item_id: b.text for b in items}
    assert all(share(text[d], item[i]) >= 0.5 for d, i in got)
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(text) - {d for d, _ in got}
    words = item[0].split()
    near = " ".join("zzz" if i % 9 == 4 and i < len(words) - 12 else w for i, w in enumerate(words))
    planted = spark.createDataFrame([(9000, "some words before " * 9 + near + " and others after it" * 9, "en", "s", 0)], SCHEMA)
    assert 0 in {r.item_id for r in decontaminate.matches(docs.unionByName(planted), bench).filter("doc_id = 9000").collect()}
    out = decontaminate.drop_leaks(edge, bench)
    assert out.columns == edge.columns and out.count() == len(EDGE)
    assert decontaminate.matches(empty, bench).count() == 0
    assert decontaminate.matches(docs, bench.filter("false")).count() == 0


def test_pipeline_against_the_stages_by_hand(spark, docs, bench):
    import corpus_pipeline

    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality_rules.judge(docs).filter("quality.kept").collect()}
    fps = brute_components((d, simhash.fingerprint(rows[d])) for d in kept)
    kept = set(fps.values())
    left = docs.filter(F.col("doc_id").isin(sorted(kept)))
    leaks = {(d, b.item_id) for d in kept for b in bench.collect() if b.text in rows[d]}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) <= kept and not set(got) & {d for d, _ in leaks}
    assert len(kept - set(got) - {d for d, _ in leaks}) <= 2  # near copies of a passage
    from tidewatch.llm.bpe_codec import codec
    with open(queries.vocabulary(), "rb") as f:
        code = codec(f.read())
    for r in pii.redact(left).collect():
        if r.doc_id in got:
            assert bytes(got[r.doc_id].ids) == code.encode(r.text)
