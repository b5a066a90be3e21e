"""Wavelet files, Merkle audit, URL templates and the pipeline."""

import gzip
import hashlib
import os
import random
import shutil
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from corpus_helpers import SMALL, documents  # noqa: F401

import corpus_pipeline
from pontualis.llm import merkle_audit, near_dedup, packing, quality_rules, url_templates, wavelet_files
from pontualis.llm.queries import QUERIES
from pontualis.llm.tables import Workspace

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_equals_the_library():
    encoder = wavelet_files.Encoder(TOKENIZER)
    rng = random.Random(3)
    parts = [*"  ab\n\n\té!'s1.,日\u3000\xa0\x1c", "<|endoftext|>", "don't", " The", "Z\u0301", "ﬁ", "ß"]
    texts = ["", " ", "  a", "a  b", "x<|endoftext|> y", "tail ", "\n\n a\nb", "a\n"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    expected = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for _ in range(2):
        for made, right in zip(encoder.ids(texts), expected):
            assert made.tolist() == right.ids


def test_shard_answers_without_unpacking():
    ids = np.random.default_rng(1).integers(0, 50257, 3000).astype(np.uint16)
    ids[::7] = 2
    planes, zeros, ranks = wavelet_files.build(ids, 16)
    shard = wavelet_files.Shard.of({"n_ids": 3000, "planes": planes, "zeros": zeros, "ranks": ranks})
    assert (shard.ids() == ids).all()
    for i in range(0, 3000, 97):
        assert shard.access(i) == ids[i] and shard.rank(2, i) == (ids[:i] == 2).sum()
    places = np.flatnonzero(ids == 2).tolist()
    assert [shard.select(2, k) for k in range(0, len(places), 13)] == places[::13]
    assert shard.select(2, len(places)) == -1 and shard.rank(70000, 3000) == 0
    empty = wavelet_files.Shard.of({"n_ids": 0, "planes": [b""] * 16, "zeros": [0] * 16, "ranks": [b"\0" * 4] * 16})
    assert empty.rank(5, 0) == 0 and len(empty.ids()) == 0


def test_documents_round_trip(spark, monkeypatch):
    monkeypatch.setattr(wavelet_files, "SHARD_IDS", 5000)
    tokenizer = wavelet_files.Encoder(TOKENIZER).tokenizer
    got = QUERIES["op4_wavelet_files"](spark, SMALL).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for r, d in zip(got, docs, strict=True):
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        assert tuple(r) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_occurrences_and_odd_rows(spark, documents):
    rows = [(None, "a"), (3, None), (3, "b b"), (3, "b b"), (1, "")]
    workspace = Workspace(spark, "test")
    wavelet_files.write_shards(documents(rows), f"{workspace.root}/w", TOKENIZER)
    got = wavelet_files.read_documents(spark, f"{workspace.root}/w").collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 2, 3, 3]
    assert sorted(r.start for r in got)[0] == 0 and next(r for r in got if r.doc_id is None).start == 0
    found = wavelet_files.occurrences(spark, f"{workspace.root}/w", 2).collect()
    assert sum(r["count"] for r in found) == 5 and all(len(r.positions) == r["count"] for r in found)
    assert wavelet_files.stored(documents(rows).limit(0), TOKENIZER).count() == 0


def test_audit_finds_exactly_the_faults(spark, monkeypatch):
    monkeypatch.setattr(merkle_audit, "FANOUT", 3)
    monkeypatch.setattr(merkle_audit, "FILE_BYTES", 20_000)
    folder = SMALL.replace("0.001", "0.01")
    rows = QUERIES["op5_merkle_audit"](spark, folder).collect()
    assert {r.page_id for r in rows if r.status == "missing"} == {i for i in (r.page_id for r in rows) if i % 1999 == 3}
    assert {r.page_id for r in rows if r.status == "damaged"} == {
        i for i in (r.page_id for r in rows) if i % 499 == 7}
    assert len(rows) == 250 and len({r.file for r in rows}) > 2
    by_file: dict = {}
    for r in rows:
        by_file.setdefault(r.file, []).append((r.seq, r.offset, r.length))
    for records in by_file.values():
        records.sort()
        assert all(a[1] + a[2] == b[1] for a, b in zip(records, records[1:]))


def test_records_are_gzip_members_and_odd_rows_pass(spark):
    record = zlib.decompress(merkle_audit.warc_record(4, "http://x/\r\nInjected: 1", "é" * 10), 31)
    assert record.startswith(b"WARC/1.1\r\n") and b"Content-Length: 20" in record
    assert b"\r\nInjected" not in record
    pages = spark.createDataFrame([(7, None, None), (7, None, None), (None, "u", "h"), (3, "", "x")],
                                  "page_id bigint, url string, html string").withColumn("record", url_templates.F.lit(1))
    rows = merkle_audit.audited(pages).collect()
    assert Counter(r.status for r in rows) == {"damaged": 2, "missing": 1, "intact": 1}
    assert merkle_audit.audited(pages.limit(0)).count() == 0
    same = Workspace(spark, "test").save(merkle_audit.archive(pages), "same")
    assert merkle_audit.audit(same, same).count() == 0
    extra = merkle_audit.audit(same.where("seq < 0"), same).collect()
    assert {r.status for r in extra} == {"extra"} and len(extra) == 4


def rule_of(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = max(((len(h + p), h + p, v) for v, h, p in url_templates.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, None))
    return host, path, best[1], best[2]


def check_urls(rows, got):
    assert Counter((i, *rule_of(u)[:3]) for i, u in rows) == Counter((r.page_id, r.host, r.path, r.rule) for r in got)
    ruled = {(i, *rule_of(u)[:2]): rule_of(u)[3] for i, u in rows}
    for r in got:
        assert r.verdict in ("allow", "block")
        assert ruled[r.page_id, r.host, r.path] in (None, r.verdict)


def test_url_rules_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()]
    check_urls(rows, QUERIES["op7_url_templates"](spark, SMALL).collect())
    hard = list(enumerate([
        None, "", "no scheme", "HTTP://A.Example.ORG/ES/x", "http://example.org/es/x?y#z", "http://example.org/en/1",
        "http://x.org", "http://badexample.org/es/", "a://b://c/d", "http://com/fr/#x", "http://h.com/a\nb/c",
        "http://h.com/" + "s/" * 20, "http://é.ÉX.com/de/1", "http://h.com?x/y"]))
    hard += [hard[-1], (None, "http://h.com/de/2")]
    frame = spark.createDataFrame(hard, "page_id bigint, url string").withColumn("host", url_templates.F.lit("x"))
    check_urls(hard, url_templates.judge_urls(frame).collect())
    assert url_templates.judge_urls(frame.limit(0)).count() == 0


def test_templates_take_the_verdict_of_their_labels(spark):
    """Under one host a bad branch is told from a good one; siblings alike are merged."""
    rules = [("block", "h.net", "/ads/"), ("allow", "h.net", "/news/"), ("allow", "h.net", "/blog/"),
             ("block", "k.net", f"/x/1")]
    urls = [f"http://h.net/ads/{i}" for i in range(40)] + [f"http://h.net/news/{i}.html" for i in range(40)]
    urls += [f"http://h.net/blog/{i}" for i in range(40)]
    urls += [f"http://k.net/x/1{i}" for i in range(60)] + ["http://k.net/x/77"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: r for r in url_templates.judge_urls(frame, rules).collect()}
    assert got[0].template.startswith("/ads/") and got[85].template == got[119].template
    last = got[len(urls) - 1]
    assert last.rule is None and last.verdict == "block" and last.purity >= url_templates.REJECT


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found, workspace = [docs], Workspace(spark, "test-pipeline")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found.append(workspace.save(stage(spark, found[-1], SMALL), f"s{i}"))
    return found


def test_pipeline_stages_do_what_their_operators_say(spark, stages):
    docs, good, unique, clean, redacted, packed = stages
    assert all(s.columns == docs.columns for s in stages[:-1])
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1")
    judged = quality_rules.quality_rules(docs, quality_rules.fit_ratio(docs, labels))
    ids = lambda frame: sorted(r.doc_id for r in frame.select("doc_id").collect())
    assert ids(good) == ids(judged.where("_out.kept"))
    assert ids(unique) == ids(near_dedup.link(good).where("kept"))
    found = QUERIES["op2_decontamination"](spark, SMALL).where("contaminated")
    assert ids(clean) == sorted(set(ids(unique)) - set(ids(found)))
    assert ids(redacted) == ids(clean)
    assert redacted.where("n_chars <> length(text)").count() == 0
    assert set(ids(packed)) == set(ids(redacted))
    sizes = {r.doc_id: r.n_words for r in packing.items_of(redacted).collect()}
    placed = Counter()
    for r in packed.collect():
        placed[r.doc_id] += r.n_words
    assert placed == sizes


def test_pipeline_of_no_documents(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_plain_texts_and_a_full_table(monkeypatch):
    """White space of every kind makes a text not plain; forgetting words changes no id."""
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [f"a{c}b" for c in spaces] + ["a b\nc", " a", "a ", "", "a", "“curly” – ぁ日本", "a \nb", "x\x00y"]
    got = wavelet_files.plain_texts(wavelet_files.texts_of(pa.array(texts))).tolist()
    assert got == [c in " \n" for c in spaces] + [True, False, False, False, True, True, False, True]
    encoder = wavelet_files.Encoder(TOKENIZER)
    rng = random.Random(4)
    words = ["a", "The", "é", "word.", "x1", "...", "it's", "日本", "<|endoftext|>", "!", "Zürich,"]
    many = [" ".join(rng.choice(words) for _ in range(30)).replace(" The", "\nThe") for _ in range(50)] + texts
    right = [c.ids for c in encoder.tokenizer.encode_batch(many, add_special_tokens=False)]
    monkeypatch.setattr(wavelet_files, "REMEMBERED", 5)
    for part in range(0, len(many), 7):
        assert [a.tolist() for a in encoder.ids(many[part:part + 7])] == right[part:part + 7]


def plain_root(records, height):
    """The tree of one file built from a list, without Spark: nodes by level and number."""
    def hashed(text):
        return hashlib.sha256(text.encode()).hexdigest()

    levels = [{i: hashed(f"{o}:{n}:{d}") for i, o, n, d in records}]
    while len(levels) < height:
        parents = {}
        for i, h in sorted(levels[-1].items()):
            parents.setdefault(i // merkle_audit.FANOUT, []).append(f"{i}:{h}")
        levels.append({i: hashed(",".join(v)) for i, v in parents.items()})
    return levels


def test_trees_of_stored_files_equal_plain_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle_audit, "FANOUT", 3)
    monkeypatch.setattr(merkle_audit, "FILE_BYTES", 3000)
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 9 * 30)) for i in range(200)],
                                  "page_id bigint, url string, html string").repartition(2)
    root, workspace = str(tmp_path / "files"), Workspace(spark, "test-merkle")
    index = merkle_audit.write_files(merkle_audit.archive(pages), root, workspace, "index")
    rows = index.orderBy("file", "offset").collect()
    names = sorted({r.file for r in rows})
    assert sorted(os.listdir(root)) == names and len(names) > 4
    for r in rows:  # every range is a whole gzip member of its file
        with open(f"{root}/{r.file}", "rb") as stream:
            stream.seek(r.offset)
            data = stream.read(r.length)
        assert hashlib.sha256(data).hexdigest() == r.sha256
        assert zlib.decompress(data, 31).endswith(f"<p>{r.page_id}</p>\r\n\r\n".encode() if r.page_id % 9 else b"\r\n\r\n")
    assert gzip.open(f"{root}/{names[0]}").read().count(b"WARC/1.1") == sum(r.file == names[0] for r in rows)
    ours = merkle_audit.stored_digests(index, root, workspace, "ours")
    levels = merkle_audit.tree(ours, workspace, "tree")
    for name in names:
        own = [(r.seq, r.offset, r.length, r.sha256) for r in rows if r.file == name]
        got = [{r.idx: r.hash for r in level.where(f"file = '{name}'").collect()} for level in levels]
        assert got == plain_root(own, len(levels))
    # A byte changed, a file cut short and a file lost in a copy of the folder.
    copy = str(tmp_path / "copy")
    shutil.copytree(root, copy)
    with open(f"{copy}/{names[0]}", "r+b") as stream:
        stream.seek(rows[0].length // 2)
        byte = stream.read(1)
        stream.seek(rows[0].length // 2)
        stream.write(bytes([byte[0] ^ 255]))
    short = [r for r in rows if r.file == names[1]]
    os.truncate(f"{copy}/{names[1]}", short[-1].offset - 1)
    os.rename(f"{copy}/{names[2]}", f"{copy}/elsewhere")
    theirs = merkle_audit.stored_digests(index, copy, workspace, "theirs")
    found = {(r.file, r.seq): r.status for r in merkle_audit.audit(ours, theirs).collect()}
    lost = {(r.file, r.seq): "missing" for r in rows if r.file == names[2]}
    assert found == {(names[0], 0): "damaged", (names[1], short[-1].seq): "missing",
                     (names[1], short[-2].seq): "damaged"} | lost
