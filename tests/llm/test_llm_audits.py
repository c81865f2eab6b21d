"""Filter interactions, source divergences and quality votes: brute force on odd rows, small cases, held-out rows."""

import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from framekeel.llm import filter_audit, quality, source_divergence
from framekeel.llm.queries import QUERIES
from framekeel.llm.sampling import labelled_texts, texts_of_each_label

LABELS = "doc_id bigint, quality int, toxic int, text string, mask int"


# --- filter interactions -------------------------------------------------------------------------


@pytest.mark.parametrize("n", range(1, 7))
def test_plain_changes_meet_each_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for place in filter_audit.plain_changes(n):
        order[place], order[place + 1] = order[place + 1], order[place]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n))))


def effects(counts, names):
    """Every order of the filters, step by step."""
    removed_in = defaultdict(int)
    rows = []
    for order in itertools.permutations(names):
        left = dict(counts)
        for step, f in enumerate(order, 1):
            bit = 1 << names.index(f)
            gone = {m: c for m, c in left.items() if m & bit}
            left = {m: c for m, c in left.items() if not m & bit}
            fails = sum(c[0] for m, c in counts.items() if m & bit)
            lost = [sum(c[k] for c in gone.values()) for k in range(3)]
            removed_in[f] += lost[0]
            kept = sum(c[0] for c in left.values())
            rows.append(("".join(order), step, kept, lost[0], fails - lost[0], counts.get(bit, [0])[0], *lost[1:], f))
    return {(*r[:-1], removed_in[r[-1]]) for r in rows}


def test_diagram_agrees_with_brute_force():
    counts = {m: (m * 7 % 13 + 1, m % 3, m % 2) for m in range(32) if m % 5}
    assert set(filter_audit.order_effects(counts, "ABCDE", 3)) == effects(counts, "ABCDE")
    assert set(filter_audit.order_effects({}, "AB", 1)) == {(o, s, 0, 0, 0, 0, 0) for o in ("AB", "BA") for s in (1, 2)}


def test_swaps_share_nodes_and_come_back():
    diagram = filter_audit.Diagram({3: (5,), 12: (5,)}, 4, 1)
    before = list(diagram.steps())
    for place in (0, 1, 2, 2, 1, 0):
        diagram.swap(place)
    assert list(diagram.steps()) == before and diagram.order == [0, 1, 2, 3]
    assert all(len(level) <= 2**k for k, level in enumerate(diagram.levels))
    # Equal counts are one leaf, so the two masks share nodes below the second level.
    assert sum(map(len, diagram.levels)) < 15


def masks(rows, labels):
    """Failure masks as the contract words them."""
    smallest = {}
    for r in rows:
        if r.doc_id is not None:
            text = r.text or ""
            smallest[text] = min(r.doc_id, smallest.get(text, r.doc_id))
    found = defaultdict(Counter)
    for r in rows:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            re.search(r"[#$%&*|]", text) is not None,
            r.doc_id is not None and r.doc_id > smallest[text],
        ]
        good, toxic = labels.get(r.doc_id, (0, 0))
        found[r.lang or ""][sum(1 << k for k, f in enumerate(fails) if f), good, toxic] += 1
    return found


def test_filters_of_odd_texts(spark, odd_docs, no_docs):
    rows = odd_docs.unionByName(
        odd_docs.sparkSession.createDataFrame(
            [(20, "A B C #", "EN"), (21, "A B C #", "EN"), (22, "a a a", None), (23, "a a a", ""), (24, "A" * 4, "en")],
            "doc_id bigint, text string, lang string",
        ),
        allowMissingColumns=True,
    )
    marks = [(1, 1, None, "t", 0), (1, 0, 1, "t", 0), (20, 1, 1, "t", 0), (99, 1, 1, "t", 0), (None, 1, 1, "t", 0)]
    labels = spark.createDataFrame(marks, LABELS)
    expected = masks(rows.collect(), {1: (1, 1), 20: (1, 1)})
    found = filter_audit.corpus_audit(rows, labels).collect()
    by_part = defaultdict(set)
    for r in found:
        by_part[r.part].add(tuple(r)[1:])
    assert len(found) == 600 * len(expected) and set(by_part) == set(expected)
    for part, cells in expected.items():
        counts = defaultdict(lambda: [0, 0, 0])
        for (mask, good, toxic), n in cells.items():
            counts[mask] = [a + b for a, b in zip(counts[mask], (n, n * good, n * toxic))]
        assert by_part[part] == effects(dict(counts), "ABCDE")
    assert filter_audit.corpus_audit(no_docs, labels).count() == 0
    assert filter_audit.corpus_audit(rows, labels.limit(0)).count() == len(found)


# --- source divergences --------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def divergences(rows):
    """``(lang, source, part, item)`` to value and rank, with plain integers."""
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r.lang or "", r.source or ""
        terms = Counter(t.translate(LOWER) for t in TERM.findall(r.text or ""))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        documents[lang].update(terms.keys())
    out = {}
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= 3]

        def shares(count, kept=kept):
            whole = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // whole for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = {o: sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept) for o in sources if o != s}
            term = {t: (p[s][t] - whole[t]) ** 2 // whole[t] for t in kept if counts[lang, s][t] and p[s][t] > whole[t]}
            for part, found, top in (("pair", pair, None), ("term", term, 200)):
                ranked = sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[:top]
                for rank, (item, value) in enumerate(ranked, 1):
                    out[lang, s, part, item] = (value, rank)
    return out


def rows_of(found):
    return {(r.lang, r.source, r.part, r.item): (r.value, r.rank) for r in found}


def test_divergences_of_odd_texts(spark, odd_docs, no_docs):
    more = [
        (30, "Straße ÉCOLE École école x2y z", "fr", "s1"),
        (31, "école École straße z z z", "fr", None),
        (32, "école x y STRASSE z", "fr", ""),
        (33, "z z école y", "fr", "s2"),
        (34, None, "fr", "s9"),
        (35, "only here", "xx", "s1"),
    ]
    rows = odd_docs.unionByName(
        spark.createDataFrame(more * 2, "doc_id bigint, text string, lang string, source string"),
        allowMissingColumns=True,
    )
    found = source_divergence.divergences(rows).collect()
    expected = divergences(rows.collect())
    assert rows_of(found) == expected and len(found) == len(expected)
    assert any(part == "term" for _, _, part, _ in expected)
    # Without kept terms, pairs differ by nothing.
    assert not [k for k in expected if k[0] == "xx"] and ("en", "", "pair", "s1") in expected
    assert source_divergence.divergences(no_docs).count() == 0


def test_divergences_in_small_blocks_and_slabs(spark, sf_dir, monkeypatch):
    """Spills, blocks and slabs of any size give the same."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = divergences(docs.collect())
    assert rows_of(source_divergence.divergences(docs).collect()) == expected
    monkeypatch.setattr(source_divergence, "BLOCK", 3000)
    monkeypatch.setattr(source_divergence, "PAIRS", 150)
    assert rows_of(source_divergence.divergences(docs).collect()) == expected


def test_stripes_are_spilled_and_pieces_are_whole(monkeypatch):
    import pyarrow as pa

    text = "Ab-ab " + "é" * 40 + " ab" * 30
    whole = Counter(t for piece in source_divergence.terms(text.encode()) for t in piece)
    assert whole == {b"ab": 32, ("é" * 40).encode(): 1}
    monkeypatch.setattr(source_divergence, "PIECE", 7)
    monkeypatch.setattr(source_divergence, "HELD", 2)
    assert Counter(t for piece in source_divergence.terms(text.encode()) for t in piece) == whole
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "a", "b"], "source": ["s", "t", "s"], "text": [text, "ab", text]})
    spills = list(source_divergence._fold(iter([batch])))
    assert len(spills) == 3 and sum(sum(map(sum, b.column("counts").to_pylist())) for b in spills) == 67


def test_shares_and_differences_are_exact():
    counts = np.array([0, 1, 10**13, 10**14 - 1])
    n, vocabulary = 10**14, 5
    assert source_divergence.shares(counts, n, vocabulary).tolist() == [
        1 + 10**9 * (int(c) + 1) // (n + vocabulary) for c in counts
    ]
    p, q = np.array([10**9 + 1, 1]), np.array([1, 10**9 + 1])
    assert source_divergence.difference(p, q).tolist() == [10**18, 10**18 // (10**9 + 1)]


# --- quality -------------------------------------------------------------------------------------


def test_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op13_quality"](spark, folder).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good = [r.predicted for r in held if truth[r.doc_id] == 1]
    bad = [r.predicted for r in held if truth[r.doc_id] == 0]
    assert sum(good) > 0.99 * len(good) and sum(bad) < 0.1 * len(bad)


def test_quality_agrees_with_brute_force(spark, sf_dir):
    """The same sample, with the latent space of a full decomposition and neighbours by a plain sort."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    learnable = labels.where("crc32(cast(doc_id as string)) % 5 <> 0")
    sample = texts_of_each_label(docs, labelled_texts(docs, learnable, "quality"), quality.SAMPLE).collect()
    held = {r.doc_id: r.quality for r in learnable.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = {(held[i], texts[i]) for i in held if i in texts}
    assert {(r.label, r.text) for r in sample} == known
    sample.sort(key=lambda r: (r.label, r.text_hash))
    found = np.stack([quality.counts(np.frombuffer(r.text.encode(), dtype=np.uint8)) for r in sample])
    label = np.array([r.label for r in sample])
    share = np.mean([held[i] for i in held if i in texts])
    model = quality.fit([(np.flatnonzero(f), f[np.flatnonzero(f)]) for f in found], label, share)
    rows = quality.weighted(found, model.rarity).astype(float)
    exact = np.linalg.svd(rows, full_matrices=False)[2][: quality.DIMENSIONS]
    spans = np.linalg.norm(exact @ model.directions, axis=1)
    assert model.directions.shape[1] == min(quality.DIMENSIONS, len(rows)) and (spans[:20] > 0.999).all()
    scores = {r.doc_id: r.score for r in QUERIES["op13_quality"](spark, sf_dir).collect()}
    for i, text in list(texts.items())[::7]:
        own = model.placed(quality.counts(np.frombuffer(text.encode(), dtype=np.uint8))[None, :])[0]
        near = sorted(((float(own @ v), k) for k, v in enumerate(model.vectors)), reverse=True)
        last = near[quality.NEIGHBOURS - 1][0]
        votes = [0.0, 0.0]
        for cosine, k in near:
            if cosine >= last - 1e-6:
                votes[label[k]] += max(cosine, 0) ** quality.SHARPNESS * model.vote[k]
        assert scores[i] == pytest.approx(votes[1] / sum(votes), abs=1e-3)


def test_quality_of_odd_texts(spark, odd_docs, no_docs):
    marks = [(1, 1, 0), (2, 1, 1), (6, 0, 0), (8, 0, 0), (8, None, 0), (3, 0, 0), (99, 1, 1), (None, 0, 0), (10, 7, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    rows = quality.judge(odd_docs, labels).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    empty = [r.score for r in rows if r.doc_id in (3, 4)]
    assert len(set(empty)) == 1
    assert quality.judge(no_docs, labels).count() == 0
    none = quality.judge(odd_docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    one = quality.judge(odd_docs, labels.where("quality = 1")).collect()
    assert all(r.predicted == 1 for r in one)
