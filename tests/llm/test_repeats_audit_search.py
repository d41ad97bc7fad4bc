"""Removal of repeats, the audit of filters and ranked search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from conftest_texts import TEXTS

# --- 11 --------------------------------------------------------------------------------------------


def _without_repeats(rows):
    """Per row: id, bytes, bytes gone, spans, hash of the rest."""
    coded = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in coded:
        if i is not None:
            for p in range(len(b) - 49):
                w = b[p : p + 50]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in coded:
        gone = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - 49):
                if first[b[p : p + 50]] < i:
                    gone[p : p + 50] = b"\1" * 50
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def _removed(llm, rows, **sizes):
    from adjudica.llm import suffix_dedup

    docs = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, suffix_dedup.Sizes(**sizes)).collect()
    for r in got:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"]) and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got)


def _repeating():
    pick = random.Random(11)
    word = lambda: "".join(pick.choice("abcdeé ") for _ in range(pick.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    lines = [text(16) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [text(pick.randrange(1, 30))]
        for _ in range(pick.randrange(4)):
            line = pick.choice(lines)
            parts += [line[pick.randrange(20) :] if pick.random() < 0.4 else line, text(pick.randrange(8))]
        rows.append((pick.choice([i, i, i, None, i // 2]), "".join(parts)))
    long_ = text(700)
    rows += [(500, long_), (501, long_[:900] + "X" + long_[900:]), (502, long_), (502, long_), (503, "ab" * 400), (504, "ab" * 300), (505, "q" * 49), (506, "q" * 49), (507, "q" * 50), (508, "z" + "q" * 51)]
    return rows + TEXTS


@pytest.mark.parametrize("sizes", [{}, {"block": 3000, "slice": 700, "bucket": 1500, "hot": 2}])
def test_repeats_equal_brute_force(llm, sizes):
    rows = _repeating()
    assert _removed(llm, rows, **sizes) == _without_repeats(rows)


def test_suffix_order_survives_hash_collisions(monkeypatch):
    from adjudica.llm import suffix_dedup as s

    pick = np.random.default_rng(3)
    text = np.append(pick.integers(97, 99, 4000, dtype=np.uint8), np.zeros(64, np.uint8))
    text[1000:1300] = text[:300]
    at = np.arange(3900)
    group = np.sort(pick.integers(0, 3, len(at)))
    known = {}
    want = [known.setdefault((g, text[p : p + 50].tobytes()), len(known)) for g, p in zip(group, at, strict=True)]
    true_of = s.Prefixes.of
    rounds = []
    monkeypatch.setattr(s.Prefixes, "of", lambda self, a, n: true_of(self, a, n) & np.uint64(rounds[-1]))
    true_init = s.Prefixes.__init__
    # In the first round two of three hashes collide, in the second none.
    monkeypatch.setattr(s.Prefixes, "__init__", lambda self, d, r=0: (rounds.append(3 if r == 0 else 2**64 - 1), true_init(self, d, r))[1])
    run = s.suffix_runs(text, group, at)
    assert len(rounds) > 1
    assert len(set(zip(run, want, strict=True))) == len(set(run)) == len(set(want))


# --- 12 --------------------------------------------------------------------------------------------


def _audit(docs, labels):
    def fails(i, t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        return {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": re.search(r"[#$%&*|]", t) is not None,
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs),
        }

    rows = [(s or "", fails(i, t or ""), any(k == i and q == 1 for k, q, _ in labels if i is not None), any(k == i and x == 1 for k, _, x in labels if i is not None)) for i, t, s in docs]
    out, credit = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                at = [0] * 6
                for _, bad, good, toxic in (r for r in rows if r[0] == part):
                    before = any(bad[g] for g in order[:step])
                    gone = bad[f] and not before
                    for k, hit in enumerate((not before and not bad[f], gone, bad[f] and before, bad[f] and sum(bad.values()) == 1, gone and good, gone and toxic)):
                        at[k] += hit
                out[part, "".join(order), step + 1] = at
                credit[part, f] += at[1]
    return {k: (*v, credit[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force(llm):
    from adjudica.llm import filter_audit

    pick = random.Random(12)
    docs = []
    for i in range(60):
        text = " ".join(pick.choice(["w", "Word", "x$", "y"]) + (str(k) if pick.random() < 0.8 else "") for k in range(pick.choice([10, 199, 200, 260])))
        docs.append((pick.choice([i, i, None, i // 3]), text, pick.choice(["a", "b", "", None])))
    docs += [(i, docs[k][1], "b") for i, k in ((100, 1), (101, 1), (None, 1), (0, 1), (0, 1))] + [(i, t, "odd") for i, t in TEXTS]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(50)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    cells = filter_audit.masks(llm.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(4), llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (*filter_audit.COUNTS, "shapley")) for r in filter_audit.audit(cells).collect()}
    assert got == _audit(docs, labels)


# --- 13 --------------------------------------------------------------------------------------------


def _terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _search(docs, items, k):
    held = [(i, Counter(_terms(t))) for i, t in docs if _terms(t)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(_terms(t))
    out = set()
    for i, terms in asked.items():
        scored = []
        for d, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // length
            score = 0
            for t, times in terms.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in x for _, x in held) + 1)))
                    score += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out |= {(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])}
    return out


@pytest.mark.parametrize("at_once", [10, 10_000])
def test_search_equals_brute_force(llm, at_once):
    from adjudica.llm import bloom_search

    pick = random.Random(13)
    vocabulary = [f"t{int(pick.paretovariate(0.6)) % 400}" for _ in range(3000)] + ["Éa", "中文", "O'k"]
    docs = [(pick.choice([i, i, i // 2]), " ".join(pick.choice(vocabulary) for _ in range(pick.choice([1, 5, 40, 300])))) for i in range(300)]
    docs += TEXTS + [(900, " ".join(f"long{k}" for k in range(6000)) + " t1 t2")]
    items = [(i, " ".join(pick.choice(vocabulary) for _ in range(12))) for i in range(12)] + [(50, "one TWO two"), (50, "fox"), (51, None), (52, "..."), (53, "absent"), (54, "long7")]
    got = bloom_search.search(llm.createDataFrame(docs, "doc_id bigint, text string").repartition(4), llm.createDataFrame(items, "item_id bigint, text string"), 7, at_once=at_once)
    assert {tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()} == _search(docs, items, 7)


def test_signatures_never_miss_a_term():
    import pyarrow as pa

    from adjudica.llm import bloom_search as b

    texts = [" ".join(f"w{k % 37}" for k in range(n)) for n in (1, 10, 100, 1000)]
    batch = pa.RecordBatch.from_pydict({"a": list(range(4)), "t": texts, "h": [0] * 4})
    for block in b._signatures(iter([batch])):
        row = {n: block.column(n)[0].as_py() for n in block.schema.names}
        model = b.Model([0], [b"w3"], np.array([[1000]]), 4, 1111)
        bound = b._bounds(row, model, b._seeds(model.terms))[0]
        for d, top in zip(row["ids"], bound, strict=True):
            c = Counter(_terms(texts[d]))
            exact = 1000 * b._share(c["w3"], b._norm(sum(c.values()), model)) if c["w3"] else 0
            assert top >= exact


# --- 10 --------------------------------------------------------------------------------------------


def test_a_long_quotation_leaves_its_own_words_only(llm, monkeypatch):
    from adjudica.llm import winnowing

    written = []
    true_stage = winnowing.stage
    monkeypatch.setattr(winnowing, "stage", lambda df, label: written.append((label, true_stage(df, label))) or written[-1][1])
    words = [f"w{k % 977}x{k}" for k in range(20_000)]
    docs = [(1, " ".join(words)), (2, "w1 w2")]
    got = winnowing.contamination(llm.createDataFrame(docs, "doc_id bigint, text string"), llm.createDataFrame([(5, " ".join(words[100:19_000]))], "item_id bigint, text string"))
    hits = {r["doc_id"]: (r["n"], r["items"]) for r in got.select("doc_id", winnowing.covered(got["hits"]).alias("n"), "items").collect()}
    assert hits == {1: (18_900, ["5"]), 2: (0, [])}
    # The words that hits carry are those of their windows: a few times the text, however long it is.
    held = [df for label, df in written if label == "benchmark-hits"][0]
    assert held.selectExpr("sum(size(words)) as n").first()["n"] < 5 * len(words)
