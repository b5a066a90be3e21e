"""Near-dedup, substring dedup and packing against brute force."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from corpus_helpers import SMALL, documents  # noqa: F401

from pontualis.llm import near_dedup, packing, substring_dedup
from pontualis.llm.components import components
from pontualis.llm.queries import ORACLE_SQL, QUERIES
from pontualis.llm.tables import Workspace, join_unique
from pontualis.llm.words import LOWER, NOT_SPACE, mix, texts_of, words_of


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


substring_dedup_lower = {c: c + 32 for c in range(65, 91)}


def classes(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= 75 * len(sets[x] | sets[y]):
                low, high = sorted((root(x), root(y)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_dedup_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    expected = duck.sql(ORACLE_SQL["op3_near_dedup"])
    got = QUERIES["op3_near_dedup"](spark, SMALL).select(*expected.columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected.fetchall())


def varied(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randint(0, 10**6)}"
    return " ".join(out)


def test_near_copies_around_the_limit(spark, documents, monkeypatch):
    """Families whose pairs lie on both sides of the limit, chains, and short texts."""
    monkeypatch.setattr(near_dedup, "BLOCK", 400)
    monkeypatch.setattr(near_dedup, "STAR", 3)
    rng, texts = random.Random(8), []
    for size, change in ((150, 4), (150, 6), (60, 2), (25, 1), (400, 12)):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
        texts += [varied(rng, words, change) for _ in range(22)]
        chain = words
        for _ in range(6):
            chain = varied(rng, chain, max(1, change // 2)).split(" ")
            texts.append(" ".join(chain))
    texts += ["a b", "A  b", "a b c", "", None, "a b c d e", "a b c d e", " ".join("xyz" * 40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    expected = classes(rows)
    got = near_dedup.link(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in expected.values()}) < len(rows) - 20


def test_near_dedup_of_odd_rows(spark, documents):
    text = "one two three four five six"
    rows = [(5, text), (5, text), (3, text.upper()), (None, text), (None, None), (7, None), (8, ""),
            (9, "other words here now ok"), (9, text + " seven")]
    docs = documents(rows)
    got = sorted(map(str, near_dedup.link(docs).collect()))
    assert len(got) == len(rows) == sum(1 for _ in got)
    by_id = defaultdict(set)
    for r in near_dedup.link(docs).collect():
        by_id[r.doc_id].add((r.component_id, r.kept))
    assert by_id[5] == {(3, False)} and by_id[3] == {(3, True)}
    assert by_id[None] == {(None, True)} and by_id[7] == {(7, True)} and by_id[8] == {(8, True)}
    assert len(by_id[9]) == 1
    left = near_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == {3: 1, None: 2, 7: 1, 8: 1, 9: 1}
    assert near_dedup.link(docs.limit(0)).count() == 0


def test_corrected_estimates_are_unbiased():
    rng = np.random.default_rng(3)
    for shared, own in ((300, 100), (900, 50), (20, 5), (0, 400)):
        values = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, shared + 2 * own, dtype=np.int64).astype(np.uint64) * np.uint64(2)
            sets = [np.unique(np.concatenate((pool[:shared], p))) for p in
                    (pool[shared:shared + own], pool[shared + own:])]
            regs = near_dedup.registers_of(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
            n = np.array([len(sets[0])])
            values.append(near_dedup.estimate(regs[:1], regs[1:], n, n)[0][0])
        assert abs(np.mean(values) - shared / (shared + 2 * own)) < 0.03
    full = near_dedup.filled(near_dedup.registers_of(np.array([1 << 60], np.uint64), np.array([0, 0, 1])))
    assert not full[0].any() and full[1].all()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(300, 330)]
    links = spark.createDataFrame(chain + star + [(2, 310), (2, 310)], "a bigint, b bigint").repartition(5)
    got = dict(map(tuple, components(Workspace(spark, "test"), links, "c").collect()))
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in (7, 2, *range(300, 330))} == {2}
    assert components(Workspace(spark, "test"), links.limit(0), "c").count() == 0


def test_hot_keys_join_like_others(spark, monkeypatch):
    import pontualis.llm.tables as tables
    monkeypatch.setattr(tables, "HOT_SHARE", 0.0)
    left = spark.range(3000).selectExpr("id", "IF(id < 2000, 0, id) AS k")
    right = left.groupBy("k").count().where("k % 2 = 0").withColumnRenamed("count", "n")
    got = join_unique(left, right, ["k"], "n", 3000)
    assert got.count() == left.join(right, "k").count()
    assert join_unique(left, right, ["k"], "n", 3000, "left").count() == 3000


def chosen_windows(text, stops, least, reach=substring_dedup.REACH):
    """Of ``reach`` windows in a row inside one sentence the one with the smallest hash."""
    words = words_of(texts_of(pa.array([text])), NOT_SPACE, LOWER)
    values, out = words.hash.tolist(), set()
    base, whole = substring_dedup._BASES[0], {}
    for j in range(len(values) - least + 1):
        if not any(stops[j:j + least - 1]):
            total = sum(v * pow(base, k, 1 << 64) for k, v in enumerate(values[j:j + least]))
            whole[j] = int(mix(np.array([total % (1 << 64)], np.uint64))[0])
    for j in whole:
        run = range(j, j + reach)
        if all(k in whole for k in run):
            low = min(whole[k] for k in run)
            out |= {(k, k + least) for k in run if whole[k] == low}
    return out


def brute_units(rows, least=substring_dedup.MIN_WORDS):
    first, out = {}, defaultdict(list)
    for d, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        text = text or ""
        w = [(*m.span(), m.group().translate(substring_dedup_lower))
             for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        if not w:
            continue
        gaps = [text[b:w[i + 1][0]].count("\n") if i + 1 < len(w) else 2 for i, (_, b, _) in enumerate(w)]
        stops = [g > 0 or x[2][-1] in ".!?" for g, x in zip(gaps, w)]
        ends, lines, paragraphs = ([i + 1 for i, m in enumerate(marks) if m] for marks in (
            stops, [g > 0 for g in gaps], [g > 1 for g in gaps]))
        begins = [0, *ends[:-1]]
        units = {*zip([0, *lines[:-1]], lines), *zip([0, *paragraphs[:-1]], paragraphs)}
        units |= {(s, next(e for e in ends if e >= s + least)) for s in begins if ends[-1] >= s + least}
        units |= {(max(s for s in begins if e - s >= least), e) for e in lines if e >= least}
        units |= {(e - least, e) for e in ends if e >= least}
        units |= chosen_windows(text, stops, least)
        for s, e in sorted(units):
            key = tuple(x[2] for x in w[s:e])
            known = first.setdefault(key, (d, e))
            if known[0] != d or s >= known[1]:
                out[d, known[0]].append((w[s][0], w[e - 1][1]))
    spans = set()
    for (d, f), found in out.items():
        found = sorted(set(found))
        now = [*found[0], 1]
        for a, b in found[1:]:
            if a <= now[1]:
                now = [now[0], max(now[1], b), now[2] + 1]
            else:
                spans.add((d, *now[:2], f, now[2]))
                now = [a, b, 1]
        spans.add((d, *now[:2], f, now[2]))
    return spans


def test_substring_dedup_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in QUERIES["op6_substring_dedup"](spark, SMALL).collect()}
    assert got == brute_units(rows) and got


def test_passages_inside_lines_are_removed(documents):
    passage = " ".join(f"w{i}" for i in range(30)) + ". And so on it goes."
    rows = [(5, f"Intro, mid {passage} Then y."), (2, f"Other é😀 start. {passage}\nend"), (7, None), (8, ""),
            (None, passage), (9, passage.upper()), (9, passage.upper()), (1, "a b c")]
    docs = documents(rows)
    spans = substring_dedup.find_repeats(docs).collect()
    assert {(r.doc_id, r.first_doc_id) for r in spans} <= {(5, 2), (9, 2)} and any(r.doc_id == 9 for r in spans)
    left = substring_dedup.remove_repeats(docs).collect()
    assert len(left) == len(rows)
    texts = dict(rows)
    for r in left:
        pieces = "".join((texts[r.doc_id] or "")[s.start:s.end] for s in r.kept_spans)
        assert (r.text or "") == pieces
        assert r.doc_id not in (2, 1) or r.text == texts[r.doc_id]
    assert substring_dedup.find_repeats(docs.limit(0)).count() == 0


def test_packing_takes_the_tightest_compatible_bin():
    rng = random.Random(1)
    lengths = sorted([0] * 10 + [rng.randint(0, 50) for _ in range(400)], reverse=True)
    sources = [rng.choice([*"aaabcdef", None]) for _ in lengths]
    clusters = [rng.randint(0, 150) for _ in lengths]
    state: dict[int, tuple] = {}
    for item, (number, offset) in zip(zip(lengths, sources, clusters),
                                      packing.pack_items(lengths, sources, clusters, 50)):
        length, source, cluster = item
        fits = {n: r for n, (r, s, c) in state.items()
                if r >= length and (source is None or source not in s) and cluster not in c}
        if number in state:
            assert number in fits and fits[number] == min(fits.values())
        else:
            assert not fits
        residual, s, c = state.get(number, (50, set(), set()))
        assert offset == 50 - residual
        state[number] = (residual - length, s | {source}, c | {cluster})


def test_packing_of_documents(spark, documents, monkeypatch):
    docs = spark.createDataFrame(
        [(None, "a b", None), (3, None, "s"), (3, "b", "s"), (3, "b", "s"), (1, "", "s"), (9, "w " * 5000, "s"),
         (4, "b", "t"), (5, "x", "t")], "doc_id bigint, text string, source string")
    for group in (8192, 1):
        monkeypatch.setattr(packing, "GROUP", group)
        got = packing.pack(packing.items_of(docs)).collect()
        assert len(got) == 10 and sum(r.n_words for r in got) == 5006
        used = defaultdict(list)
        for r in got:
            used[r.bin_id].append((r.bin_offset, r.n_words))
        for spans in used.values():
            assert all(a + n <= packing.CAPACITY for a, n in spans)
            spans = sorted(s for s in spans if s[1])
            assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert packing.pack(packing.items_of(docs.limit(0))).count() == 0


def test_packed_bins_hold_no_conflict(spark):
    folder = SMALL
    placed = QUERIES["op10_best_fit_packing"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source")
    rows = placed.join(docs, "doc_id").collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert max(Counter((r.bin_id, r.source) for r in rows).values()) == 1
