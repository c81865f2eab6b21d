"""Queries of the operators against SQL, or against brute force where SQL cannot express them."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from check import compare
from framekeel.llm import language, toxicity
from framekeel.llm.queries import QUERIES, SQL, tokenizer_path
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@pytest.mark.parametrize("name", SQL)
def test_agrees_with_sql(spark, tables, sf_dir, name):
    problem, n = compare(spark, tables, sf_dir, name, QUERIES[name], SQL[name])
    assert problem is None and n > 0


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def accuracy(rows, truth):
    return sum(truth[r.doc_id] == r.lang_pred for r in rows) / len(rows)


def test_languages_are_told_apart(spark, documents, sf_dir):
    rows = QUERIES["op1_language_id"](spark, sf_dir).collect()
    truth = {i: r.lang for i, r in documents.items()}
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert accuracy([r for r in rows if r.held_out], truth) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def grams(raw):
    """How often each bucket occurs: runs of two to four bytes inside a word with a space on either side."""
    found = defaultdict(int)
    for order in language.ORDERS:
        for at in range(len(raw) - order + 1):
            run = raw[at : at + order]
            if b" " in run[1:-1] or not run.strip():
                continue
            value = (int.from_bytes(run, "little") ^ (order * 0x01000193)) * 0x9E3779B1 % 2**32
            value = (value ^ (value >> 15)) * 0x85EBCA6B % 2**32
            found[value >> (32 - language.BITS)] += 1
    return found


def test_language_agrees_with_brute_force(spark, sf_dir, monkeypatch):
    """The sample is all that may be learned, and every score is that of the model on the whole text."""
    seen, fit = [], language.fit

    def watched(rows):
        seen.append((rows, fit(rows)))
        return seen[-1][1]

    monkeypatch.setattr(language, "fit", watched)
    predicted = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, sf_dir).collect()}
    [(rows, model)] = seen
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", "lang", language.letters(docs["text"]).alias("text")).collect()
    counted = {r.doc_id: grams((r.text or "").encode()) for r in docs}
    learned = {
        (r.lang, tuple(sorted(counted[r.doc_id].items())))
        for r in docs
        if r.lang is not None and len(r.text or "") > 2 and zlib.crc32(str(r.doc_id).encode()) % 4 != 2
    }
    assert {(name, tuple(zip(at.tolist(), n.astype(int).tolist()))) for at, n, name in rows} == learned
    for doc_id, found in counted.items():
        r = predicted[doc_id]
        if not found:
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
            continue
        total = sum(found.values())
        logits = [
            (sum(n * float(model.table[at, k]) for at, n in found.items()) / total + model.bias[k]) / model.temperature
            for k in range(len(model.languages))
        ]
        shares = [math.exp(x - max(logits)) for x in logits]
        best = max(range(len(shares)), key=shares.__getitem__)
        assert r.score == pytest.approx(shares[best] / sum(shares), abs=1e-5)
        assert r.lang_pred == model.languages[best] and r.accepted == (r.score >= model.threshold)


STRONG = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 8, "access": 16, "hex": 32}


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(STRONG.items()):
        for m in pattern.finditer(text):
            if len(m.group(2 if kind == "assign" else 0)) >= LEAST[kind]:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def test_secrets_agree_with_brute_force(spark, documents):
    rows = QUERIES["op2_secret_scan"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    expected = {r.doc_id: base_spans(r.text or "") for r in docs}
    assert len(rows) == len(docs) and any(expected.values())
    for r in rows:
        base = expected[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) or not base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in STRONG)


def test_edited_texts_are_right(spark, documents, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op4_syncmers"](spark, sf_dir).collect()}
    order = sorted(documents, reverse=True)
    prints = defaultdict(set)
    for k, i in enumerate(order):
        text, following = documents[i].text or "", documents[order[(k + 1) % len(order)]].text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints[text].add(rows[i].fingerprint)
        prints[edited].add(rows[i].edited_fingerprint)
    assert all(len(found) == 1 for found in prints.values())
    long = [r for r in rows.values() if r.n_chars > 500]
    # Texts that repeat a phrase have few distinct anchors, and the next document may be a copy.
    assert sum(0.35 < r.near_edited < 0.75 for r in long) > 0.85 * len(long)
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)
    assert sum(r.near_next for r in long) / len(long) < 0.1


def test_toxicity_is_found_in_rows_that_were_held_out(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(rows) == 10_000 and all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows.values())
    held = [r for r in labels if rows[r.doc_id].held_out]
    clean = [rows[r.doc_id].predicted for r in held if r.toxic == 0]
    toxic = [rows[r.doc_id].predicted for r in held if r.toxic == 1]
    assert sum(clean) < 0.02 * len(clean) and sum(toxic) > 0.8 * len(toxic)


def test_toxicity_agrees_with_brute_force(spark, sf_dir, monkeypatch):
    """The weights are where the plain loss is least, and every score is the sum over a whole text's distinct words."""
    seen, fit, train = {}, toxicity.fit, toxicity.train

    def watched_fit(rows, n_features, prior_shift):
        seen["fit"] = rows, n_features, prior_shift, fit(rows, n_features, prior_shift)
        return seen["fit"][-1]

    def watched_train(*tables):
        seen["model"] = train(*tables)
        return seen["model"]

    monkeypatch.setattr(toxicity, "fit", watched_fit)
    monkeypatch.setattr(toxicity, "train", watched_train)
    scores = {r.doc_id: r.score for r in QUERIES["op5_toxicity"](spark, sf_dir).collect()}
    rows, n, shift, (weights, bias) = seen["fit"]
    held, swapped = np.zeros((len(rows), n)), []
    for k, r in enumerate(rows):
        held[k, r.own] = 1
        for lost, brought in zip(r.lost, r.brought):
            if lost or brought:
                swapped.append(np.zeros(n))
                swapped[-1][brought] += 1
                swapped[-1][lost] -= 1
    label, moves = np.array([r.label for r in rows]), np.array(swapped).reshape(len(swapped), n)

    def loss(w, b):
        logit = held @ w + b
        change = (moves @ w) ** 2
        ridge = toxicity.RIDGE / 2 / len(rows) * (w**2).sum()
        return (np.logaddexp(0, logit) - label * logit).mean() + ridge + toxicity.COUNTERFACTUAL * (change.mean() if len(change) else 0)

    step = 1e-4
    for k in range(n):
        aside = np.zeros(n)
        aside[k] = step
        assert abs(loss(weights + aside, bias - shift) - loss(weights - aside, bias - shift)) / (2 * step) < 1e-3
    assert abs(loss(weights, bias - shift + step) - loss(weights, bias - shift - step)) / (2 * step) < 1e-3

    known = dict(zip(seen["model"].hashes.tolist(), weights))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in docs.select("doc_id", toxicity.letters(docs["text"]).alias("text")).collect():
        found = {h for word in set((r.text or "").split()) for h in toxicity.features(word).tolist()}
        logit = bias + sum(known.get(h, 0.0) for h in found)
        assert scores[r.doc_id] == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-6)


def test_swapped_terms_move_held_out_scores_little(spark):
    """Held-out texts with a group named at their start: another group, or none, changes scores by little."""
    from framekeel.llm import toxicity
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    held = docs.where("crc32(cast(doc_id as string)) % 4 = 2").where("length(text) < 2000")
    scores = {}
    for term in ("people", "women", "muslims", "refugees"):
        named = held.withColumn("text", F.concat(F.lit(f"About {term}. "), "text"))
        scores[term] = {r.doc_id: r.score for r in toxicity.score(named, model, "doc_id").collect()}
    for term in ("women", "muslims", "refugees"):
        moved = np.array([abs(scores[term][i] - scores["people"][i]) for i in scores["people"]])
        assert moved.mean() < 0.01 and moved.max() < 0.15


def assert_packed(rows, texts, tokenizer, length=2048):
    """Rows by document and by sequence hold what the tokenizer says; gives the numbers of sequences and tokens."""
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_row[r.row].append(r)
        by_sequence[r.sequence_id].append(r)
    tokens = 0
    assert set(by_row) == set(texts)
    for key, pieces in by_row.items():
        ids = [*tokenizer.encode(texts[key] or "", add_special_tokens=False).ids, 0]
        tokens += len(ids)
        pieces.sort(key=lambda r: r.piece)
        bounds = [0, *range(len(ids) % length or length, len(ids) + 1, length)]
        assert [(r.piece, r.start, r.start + r.length) for r in pieces] == [
            (k, a, b) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))
        ]
        for r in pieces:
            own = np.array(ids[r.start : r.start + r.length], dtype="<u4")
            assert r.ids_crc32 == zlib.crc32(own.tobytes())
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_sequence), tokens


def test_packing_is_whole_and_tight(spark, documents, sf_dir, tokenizer):
    rows = QUERIES["op8_best_fit_packing"](spark, sf_dir).withColumnRenamed("doc_id", "row").collect()
    sequences, tokens = assert_packed(rows, {i: r.text for i, r in documents.items()}, tokenizer)
    assert sequences <= 1.01 * -(-tokens // 2048) + 1


def shingles(text, width):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def brute_components(texts, width, percent):
    """``key`` to the size of its set and the least key it can reach."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    component = {i: i for i in sets}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    keys = sorted(sets)
    for n, i in enumerate(keys):
        for j in keys[:n]:
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    a, b = sorted((root(i), root(j)))
                    component[b] = a
    return {i: (len(sets[i]), root(i)) for i in keys}


def test_jaccard_agrees_with_brute_force(spark, documents, sf_dir):
    rows = QUERIES["op9_ngram_jaccard"](spark, sf_dir).collect()
    expected = brute_components({i: r.text for i, r in documents.items()}, 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected and len(rows) == len(expected)


def test_pipeline_agrees_with_brute_force(spark, documents, sf_dir, tokenizer):
    """Each stage on what its predecessor kept."""
    from framekeel.llm.common import staged

    kept, docs = [], spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        kept.append(docs.collect())
    toxic_free, distinct, apart, mixed, packed = kept
    judged = QUERIES["op5_toxicity"](spark, sf_dir)
    assert {r.doc_id for r in toxic_free} == {r.doc_id for r in judged.where("predicted = 0").collect()}
    first = {}
    for r in sorted(toxic_free, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert sorted(r.doc_id for r in distinct) == sorted(first.values())
    reach = brute_components({r.doc_id: r.text for r in distinct}, 5, 80)
    assert sorted(r.doc_id for r in apart) == sorted(i for i, (_, low) in reach.items() if i == low)
    size = {r.doc_id: len(WORD.findall(r.text)) for r in apart}
    by_source = defaultdict(int)
    times = defaultdict(int)
    for r in apart:
        by_source[r.source] += size[r.doc_id]
    wanted = shared_out(by_source)
    for r in mixed:
        times[r.doc_id] += 1
    assert max(times.values()) <= 3
    for source, target in wanted.items():
        taken = sum(size[r.doc_id] for r in mixed if r.source == source)
        longest = max(size[r.doc_id] for r in apart if r.source == source)
        assert abs(taken - target) <= longest
    texts = {}
    for r in packed:
        texts[r.row_id] = documents[r.doc_id].text
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(r.doc_id for r in mixed)
    rows = spark.createDataFrame(packed, docs.schema).withColumnRenamed("row_id", "row").collect()
    assert_packed(rows, texts, tokenizer)


def shared_out(sizes):
    """Targets by handing the excess on until none is above three times its source."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    stopped, target = set(), {}
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        open_weight = sum(weight[s] for s in names if s not in stopped)
        target = {s: 3.0 * sizes[s] if s in stopped else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in stopped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        stopped |= over
