"""The five stages against plain Python, each on its own input, and run() against their chain."""

import random
from collections import Counter

from test_methods import _base, _components, _contamination

ENGLISH = "the and of to in that was for with his they at be this from have or by one had not but what all were when we there can an your which".split()
FRENCH = "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas vous par sur faire plus dire me on mon lui nous comme".split()


def _tables(llm, folder):
    pick = random.Random(77)
    item = lambda: " ".join(pick.choice(ENGLISH) + str(pick.randrange(99)) for _ in range(pick.choice([6, 14, 30])))
    items = [(k, item()) for k in range(6)] + [(7, None)]
    docs = []
    for k in range(120):
        lang, words = pick.choice([("en", ENGLISH), ("fr", FRENCH)])
        text = [pick.choice(words) for _ in range(pick.randrange(30, 160))]
        if k % 9 == 0:
            text.insert(20, pick.choice(items[:6])[1])
        if k % 7 == 0:
            text.insert(10, 'token = "' + "".join(pick.choice("0123456789abcdef") for _ in range(24)) + '"')
        docs.append((k, " ".join(text), lang))
        if k % 5 == 0:
            near = [w if pick.random() > 0.01 else "changed" for w in text]
            docs += [(k + 1000, " ".join(near), lang), (k + 2000, " ".join(text), lang)]
    third = next(d for d in docs if d[0] == 3)
    docs += [(500, None, None), (501, "", None), (502, "123 456", None), (None, third[1] + " end", "en"), third]
    rows = [(i, t, lang, f"s{(i or 0) % 3}", len(t or "")) for i, t, lang in docs]
    llm.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).write.parquet(f"{folder}/documents.parquet")
    llm.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_stages_equal_plain_python(llm, tmp_path):
    import sentencepiece

    import corpus_pipeline
    from adjudica.llm.queries import tokenizer_path

    folder = str(tmp_path)
    rows, items = _tables(llm, folder)
    docs, seen = llm.read.parquet(f"{folder}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        docs = function(llm, docs, folder)
        docs.write.parquet(f"{folder}/{name}.parquet")
        docs = llm.read.parquet(f"{folder}/{name}.parquet")
        seen[name] = docs.collect()
    got = {name: Counter((r["doc_id"], r["text"]) for r in found) for name, found in seen.items() if name != "encode"}

    # Language: what has no letters goes; every text of the two languages stays.
    assert got["language"] == Counter((i, t) for i, t, *_ in rows if i not in (500, 501, 502))

    # Near-duplicates: the smallest id of each component, once; a row without id stays.
    before = [x for x in got["language"] if x[0] is not None]
    kept = {i for i, (_, _, keep) in _components(before).items() if keep}
    assert got["near_dedup"] == Counter([x for x in before if x[0] in kept] + [x for x in got["language"].elements() if x[0] is None])
    assert sum(got["near_dedup"].values()) < 125

    # Benchmark passages: rows of which no word is hit.
    before = list(got["near_dedup"].elements())
    clean = Counter(i for i, _, hit, _ in _contamination(before, items) if not hit)
    assert Counter(i for i, _ in got["decontaminate"].elements()) == clean and not got["decontaminate"] - got["near_dedup"]
    assert 0 < sum(clean.values()) < len(before)

    # Secrets: texts without a fixed form keep every word, the others lose the form and nothing before it.
    texts = {r["doc_id"]: r["text"] for r in seen["redact_secrets"]}
    for i, t in got["decontaminate"]:
        spans = _base(t)
        if spans:
            assert texts[i].startswith(t[: spans[0][0]] + "[SECRET]") and t[spans[0][0] : spans[0][2] if len(spans[0]) > 2 else spans[0][0] + 8] not in texts[i]
        else:
            assert texts[i] == t
    assert all(r["n_chars"] == len(r["text"]) for r in seen["redact_secrets"]) and any("[SECRET]" in t for t in texts.values())

    # Ids: as the library has them.
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    assert {(r["doc_id"], tuple(r["ids"])) for r in seen["encode"]} == {(i, tuple(library.encode(t))) for i, t in texts.items()}

    whole = corpus_pipeline.run(llm, folder)
    assert whole.columns == docs.columns
    assert Counter(map(repr, whole.collect())) == Counter(map(repr, seen["encode"]))
