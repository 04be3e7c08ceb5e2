"""Every training-data operator against brute force on small texts, with odd rows and empty tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

SF = "/root/testdata/sf0.001"
ODD = [None, "", "  a  b\n\nc\t\td ", " \n", "▁▁x ▁", "é ﬁ 你好 😀 <s> <|endoftext|>x THE The, the.", "a" * 3000, "same words here again now", "Same  words here again NOW",
       "x\x1cy", " ".join(f"w{i % 700}" for i in range(6000)), "mail a@b.c_d@e.f or +1 (171) 555-7713, 4111 1111-1111 1111 and 1.2.3.4.5.6.7.8 and 999.1.1.1",
       "1 " * 3000, "a b c d e f g\na b X d e f g\n\na b c e f g\na b c d e f g h\nz\nz"]
DDL = "doc_id bigint, text string, lang string, id string, row int, n int, key string, part int, length int, label string, c int"


@pytest.fixture(scope="module")
def rows(spark):
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return real + [(10**6 + i, t) for i, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    extra = ("x", 1, 2, "k", 3, 4, "l", 5)
    return spark.createDataFrame([(d, t, "en" if d % 2 else "fr", *extra) for d, t in rows], DDL).repartition(3).cache()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact_groups(docs, rows):
    from permitflow.llm.exact_dedup import exact_groups
    text = {d: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for d, t in rows}
    same = defaultdict(list)
    for d, t in text.items():
        same[t].append(d)
    want = {d: (min(same[t]), len(same[t]), min(same[t]) == d, hashlib.sha256(t.encode()).hexdigest()) for d, t in text.items()}
    assert {r[0]: tuple(r[1:]) for r in exact_groups(docs).collect()} == want


def test_exact_groups_keep_one_of_repeated_and_null_ids(spark):
    from permitflow.llm.exact_dedup import exact_groups
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, "b " * 50)], "doc_id bigint, text string")
    found = exact_groups(df).collect()
    assert len(found) == 6 and sum(r.kept for r in found) == 3
    assert {(r.keep_id, r.group_size) for r in found} == {(1, 3), (None, 2), (2, 1)}


def brute_components(rows, width=5, percent=80):
    sets = {}
    for d, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[d] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_jaccard_components(docs, rows):
    from permitflow.llm.jaccard import jaccard_components
    assert {r[0]: (r[1], r[2]) for r in jaccard_components(docs).collect()} == brute_components(rows)


def test_jaccard_in_blocks(spark):
    from permitflow.llm.jaccard import jaccard_components
    base = [f"w{i}" for i in range(60)]
    near = [(k, " ".join(base[:k % 50] + [f"x{k}"] + base[k % 50 + 1:])) for k in range(120)]
    far = [(1000 + k, " ".join(base[:30] + [f"y{k}_{i}" for i in range(30)])) for k in range(20)]
    df = spark.createDataFrame(near + far, "doc_id bigint, text string").repartition(4)
    assert {r[0]: (r[1], r[2]) for r in jaccard_components(df, block_tokens=900).collect()} == brute_components(near + far)


def test_signature_tree_finds_every_component():
    from permitflow.llm.sigtree import Links, bitmap
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, size=int(rng.integers(3, 300)), dtype=np.uint64)
        for _ in range(5):
            own = base.copy()
            own[rng.integers(0, len(own), size=max(1, len(own) // 12))] = rng.integers(0, 2**63, dtype=np.uint64)
            sets.append(np.unique(own))
    tree = Links([len(s) for s in sets], [bitmap(s) for s in sets], 80, sets)
    tree.run()
    brute = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if both * 100 >= 80 * (len(a) + len(sets[j]) - both):
                x, y = brute[i], brute[j]
                brute = [min(x, y) if z in (x, y) else z for z in brute]
    groups = lambda label: sorted(tuple(i for i in range(len(sets)) if label(i) == k) for k in {label(i) for i in range(len(sets))})
    assert groups(tree.find) == groups(lambda i: brute[i])


def test_token_counts(docs, rows):
    sentencepiece = pytest.importorskip("sentencepiece")
    from permitflow.llm.bpe import token_counts
    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = {d: (len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for d, t in rows}
    assert {r[0]: tuple(r[1:]) for r in token_counts(docs, path).collect()} == want


def test_packing(docs, rows):
    tokenizers = pytest.importorskip("tokenizers")
    from permitflow.llm.packing import pack
    path = P.path("word_bpe_49k.json")
    model, want = tokenizers.Tokenizer.from_file(path), {}
    for d, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at:at + 4096]
            want[d, piece] = (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    found = pack(docs, path).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == want and len(found) == len(want)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in found) // 4096) + 1


def test_plan_holds_each_rank_once():
    from permitflow.llm.packing import plan_runs
    rng = np.random.default_rng(3)
    histogram = Counter(rng.integers(1, 101, size=3000).tolist())
    runs, fill = plan_runs(histogram, 100), Counter()
    by_length = defaultdict(list)
    for run in runs:
        by_length[run[0]].append(run)
    for length, count in histogram.items():
        own = by_length[length]
        for k, (_, first, sequence, each, _) in enumerate(own):
            end = own[k + 1][1] if k + 1 < len(own) else count
            for i in range(end - first):
                fill[sequence + i // each] += length
    assert max(fill.values()) <= 100 and len(fill) <= 1.02 * sum(n * k for n, k in histogram.items()) / 100 + 1


def test_warc_round_trip(spark):
    from permitflow.llm import warc
    from permitflow.llm.storage import Scratch
    pages = [(1, "http://a/", "x"), (2, None, None), (3, "http://b c/\n", "x"), (None, "u", "x"), (5, "v", "é" * 50000), (6, "w", ""), (6, "w", "")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(2)
    found = warc.archive_pages(df).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert Counter((r.row_id, r.payload_bytes, r.payload_digest) for r in found) == Counter((p, len((h or "").encode()), digest(h)) for p, _, h in pages)
    assert all(r.payload_digest == r.declared_digest for r in found)
    assert Counter((r.row_id, r.record_type, r.refers_to) for r in found) == Counter(
        [(1, "response", None), (3, "revisit", 1), (None, "revisit", 1), (2, "response", None), (6, "revisit", 2), (6, "revisit", 2), (5, "response", None)])
    scratch = Scratch(spark, "test")
    manifest = warc.write_archives(df, scratch.path("archives"), scratch)
    for split in (50, 1000):
        read = warc.read_records(manifest, split, keep_payload=True).collect()
        assert Counter((r.row_id, r.payload.decode()) for r in read) == Counter((p, h or "") for p, _, h in pages)


def test_warc_reads_pages_and_urls_that_inflate_far(spark, monkeypatch):
    from permitflow.llm import warc
    from permitflow.llm.storage import Scratch
    again = " ".join(f"word{i}" for i in range(1200)) * 400
    pages = [(1, "http://a/", again), (2, "http://b/", " " * 2_000_000), (3, "http://c/" + "u" * 2_000_000, "x"), (4, "http://d/", again), (5, None, "y")]
    assert len(again) > 3_000_000
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(1)
    found = warc.archive_pages(df).collect()
    assert {(r.row_id, r.payload_bytes, r.target_uri, r.record_type, r.refers_to) for r in found} == {
        (p, len(h), u, "revisit" if p == 4 else "response", 1 if p == 4 else None) for p, u, h in pages} and len(found) == 5
    assert all(r.payload_digest == r.declared_digest for r in found)
    scratch = Scratch(spark, "test")
    manifest = warc.write_archives(df, scratch.path("archives"), scratch)
    assert {(r.row_id, r.payload.decode()) for r in warc.read_records(manifest, 1000, keep_payload=True).collect()} == {(p, h) for p, _, h in pages}
    read = warc.read_records
    monkeypatch.setattr(warc, "read_records", lambda archives: read(archives).filter("row_id <> 5"))
    with pytest.raises(RuntimeError, match="4 records read of 5"):
        warc.archive_pages(df)


def test_line_dedup(spark):
    from permitflow.llm.line_dedup import drop_lines, duplicate_lines
    df = spark.createDataFrame([(1, ODD[-1]), (2, "\n  a b  c d e f g\nz z z z z z y\nnew line"), (3, "z z z z z z"), (4, None)], "doc_id bigint, text string")
    found = {(r[0], r[1]): r[2] for r in duplicate_lines(df).collect()}
    assert found == {(1, 1): "near", (1, 3): "near", (1, 4): "near", (1, 6): "exact", (2, 1): "exact", (3, 0): "near"}
    texts = {r.doc_id: r.text for r in drop_lines(df).collect()}
    assert texts == {1: "a b c d e f g\n\nz", 2: "\nz z z z z z y\nnew line", 3: "", 4: None}


def test_language_id(spark):
    from permitflow.llm.langid import identify
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "", "en"), (-3, "12 !! ☃", None), (None, "the and of", "en")], "doc_id bigint, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(odd)
    found = identify(both).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    held = [r for r in found if r.held_out and r.lang]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.98
    assert {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id in (-1, -2, -3)} == {k: ("und", 0.0) for k in (-1, -2, -3)}
    assert all(0 <= r.score <= 1 for r in found) and not any(r.rejected for r in found if r.lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)


def test_decontamination(spark):
    from permitflow.llm.decontaminate import report
    item = "If a train leaves Boston at 40 km per hour and Alice drives 40 km from there, when do they meet again"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "only four words here"),
                                   (4, "what is 40 plus 40 when we add the last two terms again")], "item_id bigint, text string")
    renamed = item.replace("40", "55").replace("Boston", "Leeds").replace("Alice", "Maria")
    docs = spark.createDataFrame(
        [(1, "Noise before. " + item + " noise after"), (2, "so: " + renamed.upper().lower()), (3, renamed),
             (4, "what is 55 plus 56 when we add the last two terms again"), (7, "What is 55 plus 55, when we add the last two terms again?"),
         (5, "nothing of the kind"), (6, None), (None, item)], "doc_id bigint, text string")
    found = {r.doc_id: r.contaminated for r in report(docs, bench).collect()}
    assert found == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False, 7: True, None: True}


def test_decontamination_finds_literal_copies(spark):
    from permitflow.llm.decontaminate import report
    numbers = "Compute 12 + 30, 45 + 17, 88 - 19, 63 + 21, 14 * 3, 7 * 9, 81 - 4, 5 + 6"
    names = "If Tom meets Alice in Boston and Maria waits in Leeds until Anna arrives, how many people are there in all"
    short = "Mary has twelve apples and gives away five"
    chinese = "小明有十二个苹果他给了小红五个还剩多少个"
    bench = spark.createDataFrame([(1, numbers), (2, names), (3, short), (4, chinese)], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, "so: " + numbers), (2, numbers.replace("12", "13").replace("45", "46").replace("63", "64").replace("7 *", "8 *")), (3, names.title()), (4, names.lower()),
         (5, names.upper()), (6, "now, " + short + " of them"), (7, "we know Mary has twelve pears and gives away five"), (8, "问题" + chinese + "呢"), (9, chinese[:10])],
        "doc_id bigint, text string")
    found = {r.doc_id: (r.n_windows > 0, r["items"]) for r in report(docs, bench).collect()}
    assert found == {1: (True, [1]), 2: (False, []), 3: (True, [2]), 4: (True, [2]), 5: (True, [2]), 6: (True, [3]), 7: (False, []), 8: (True, [4]), 9: (False, [])}


def test_decontamination_finds_title_case_copies_of_the_benchmark(spark):
    from permitflow.llm.decontaminate import report
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.createDataFrame([(r.item_id, r.text.title()) for r in bench.collect()], "doc_id bigint, text string")
    assert all(r.doc_id in r["items"] for r in report(docs, bench).collect())


def test_pii_base_spans(docs, rows):
    regex = pytest.importorskip("regex")
    from permitflow.llm.pii import KINDS, span_report
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(digits):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
    found = {r.doc_id: r for r in span_report(docs).collect()}
    assert len(found) == len(rows)
    for d, t in rows:
        spans, count = [], Counter()
        for kind in KINDS:
            for m in regex.finditer(patterns[kind], t or ""):
                digits = re.sub("[^0-9]", "", m.group())
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits),
                        "phone": 9 <= len(digits) <= 15}[kind]:
                    spans.append(f"{kind}:{m.start()}:{m.end()}")
                    count[kind] += 1
        r = found[d]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [count[k] for k in KINDS]
        assert set(spans) <= set(r.spans.split(","))


def test_pii_addresses_with_zero_parts(spark):
    from permitflow.llm.pii import span_report
    good = ["10.0.0.1", "192.168.0.1", "127.0.0.1", "0.0.0.0", "1.2.003.4", "00.000.0.00255", "1.2.3.4", "255.249.199.99"]
    bad = ["256.0.0.1", "0.0.0.256", "0.0.00300.0", "10.0.0.1000"]
    df = spark.createDataFrame(list(enumerate(good + bad)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in span_report(df).collect()}
    assert [found[i].n_ip for i in range(len(good + bad))] == [1] * len(good) + [0] * len(bad)
    for i, t in enumerate(good):
        assert found[i].base_sha256 == hashlib.sha256(f"ip:0:{len(t)}".encode()).hexdigest()


def test_url_filter(spark):
    from permitflow.llm.url_filter import Segmenter, judge
    urls = [(1, "http://WWW.Example.com/en/x?q#f"), (2, "https://a.example.com/en/1"), (3, "http://x.net/es/"), (4, "http://com/"), (5, "http://net"), (6, None),
            (7, "no scheme"), (None, "http://badnet/es/"), (9, "ftp://a.com?x/y")]
    df = spark.createDataFrame([(i, u, "<p>good words bad news</p>") for i, u in urls], "page_id bigint, url string, html string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(df).collect()}
    assert found[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow") and found[2][2:] == ("example.com/en/", "block")
    assert found[3][2:] == ("net/es/", "block") and found[4] == ("com", "/", "com/", "allow") and found[5][:3] == ("net", "", None)
    assert found[6][:3] == found[7][:3] == ("", "", None) and found[None][2] is None and found[9] == ("a.com", "", None, found[9][3])
    assert Segmenter({"good": 5, "news": 5, "go": 1}).split("goodnews") == ["good", "news"]


def test_url_filter_knows_rare_words(spark):
    import math
    from permitflow.llm.url_filter import Segmenter, judge
    letters = "abcdefghijklmnopqrstuvwxyz"
    common = ["q" + letters[i // 17576] + letters[i // 676 % 26] + letters[i // 26 % 26] + letters[i % 26] for i in range(52_000)]
    pages = [(1, "http://www.example.com/en/" + "/".join(common * 2), " ".join(common * 2)), (2, "http://news.net/es/zebrafinch", "zebra finch zebrafinch cheap flights"),
             (3, "http://cheapflights.org/zebrafinch/2024", None), (None, "http://zoo.org/" + common[7], ""), (5, None, None), (6, "http://cheap.org/é²ü", "")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    counts = Counter(w for _, _, h in pages for w in (h or "").split())
    segmenter, words, uses = Segmenter(counts), {}, {"block": Counter(), "allow": Counter()}
    for (i, url, _), verdict in zip(pages, ("allow", "block", None, None, None, None)):
        host, _, path = (url or "http://").removeprefix("http://").partition("/")
        words[i] = [f"{k}:{w}" for k, t in (("h", host), ("p", path)) for n in re.findall(r"[^\W\d_]+|\d+", t) for w in (["#"] if n.isdigit() else segmenter.split(n))]
        if verdict:
            uses[verdict].update(words[i])
    vocabulary = set(uses["block"]) | set(uses["allow"])
    log = lambda c, w: math.log((uses[c][w] + 1) / (sum(uses[c].values()) + len(vocabulary) + 1))
    odds = {i: sum(log("block", w) - log("allow", w) for w in ws if w in vocabulary) for i, ws in words.items()}
    found = {r.page_id: r for r in judge(df).collect()}
    assert len(vocabulary) > 50_000 and "p:zebrafinch" in words[3] and words[3][:2] == ["h:cheap", "h:flights"]
    assert {i: r.words for i, r in found.items()} == words
    assert all(math.isclose(r.block_log_odds, odds[i], rel_tol=1e-9, abs_tol=1e-9) for i, r in found.items())
    assert found[3].verdict == "block" and found[None].verdict == "allow"


def test_empty_tables(spark, docs):
    from permitflow.llm import bpe, decontaminate, exact_dedup, jaccard, langid, line_dedup, packing, pii, url_filter, warc
    none, pages = docs.limit(0), spark.createDataFrame([], "page_id bigint, url string, html string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    for out in (exact_dedup.exact_groups(none), jaccard.jaccard_components(none), bpe.token_counts(none, P.path("piece_bpe_32k.model")),
                packing.pack(none, P.path("word_bpe_49k.json")), langid.identify(none), line_dedup.line_report(none), pii.span_report(none),
                decontaminate.report(none, bench), url_filter.judge(pages), warc.archive_pages(pages)):
        assert out.count() == 0
    assert decontaminate.report(docs, bench).filter("contaminated").count() == 0


def test_pipeline_decides_by_row(spark, tmp_path):
    import corpus_pipeline
    item = "the benchmark asks how many green apples are left when all the red ones have been eaten today"
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ddl, sf = "doc_id bigint, text string, lang string", str(tmp_path)
    texts = lambda df: Counter((r.doc_id, r.text, r.lang) for r in df.collect())
    clean = [(None, "one clean text", "en"), (None, "another clean text", None), (7, "clean under a repeated id", "en")]
    mixed = spark.createDataFrame([(None, "x " + item, "en"), (7, item + " y", "en"), *clean], ddl).repartition(3)
    found = corpus_pipeline.decontamination(spark, mixed, sf)
    assert texts(found) == Counter(clean) and found.columns == mixed.columns
    copies = spark.createDataFrame([(None, "a b", "en"), (None, "a  b", "en"), (3, "a b", "en"), (None, "c", "en"), (None, "c", "en"), (5, "d", "en"), (5, "e", "en"), (5, "e", "en")], ddl)
    found = corpus_pipeline.exact_dedup(spark, copies.repartition(3), sf)
    assert texts(found) == Counter([(3, "a b", "en"), (None, "c", "en"), (5, "d", "en"), (5, "e", "en")]) and found.columns == copies.columns
    long = " ".join(f"w{i}" for i in range(60))
    near = spark.createDataFrame([(None, long, "en"), (None, long + " z", "en"), (4, long + " y", "en"), (None, "", "en"), (None, None, "en"), (4, "quite another text it is", "en"),
                                  (None, "p q r s t u v", "en"), (None, "p q r s t u v", "en")], ddl)
    found = corpus_pipeline.ngram_jaccard(spark, near.repartition(3), sf)
    assert texts(found) == Counter([(4, long + " y", "en"), (None, "", "en"), (None, None, "en"), (4, "quite another text it is", "en"), (None, "p q r s t u v", "en")])
    assert found.columns == near.columns


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = corpus_pipeline.language_id(spark, docs, SF)
    assert first.columns == docs.columns and first.count() == docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard", "decontamination", "best_fit_packing"]
