import corpus_pipeline
from plumbline.llm.queries_tokens import tokenizer_path


def test_stages_in_order(spark, sf_dir):
    """Each stage's output is written and read again, and later stages find nothing left for them to have missed."""
    from plumbline.llm.bpe import Codec
    from plumbline.llm.common import stored, table
    from plumbline.llm.decontaminate import verified
    from plumbline.llm.ngram_join import near_components
    from plumbline.llm.secrets import spans

    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
        seen[name] = docs
        if name != "bpe":
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    assert ids["toxicity"] >= ids["ngram_jaccard"] >= ids["decontamination"] == ids["secret_scan"] == ids["bpe"]
    groups = near_components(seen["toxicity"]).collect()
    assert ids["ngram_jaccard"] == {r.component_id for r in groups}
    assert verified(spark, seen["decontamination"], table(spark, sf_dir, "benchmark")).count() == 0
    c = Codec(tokenizer_path())
    text = {r.doc_id: r.text for r in seen["secret_scan"].collect()}
    assert not any(s[0] != "assign" or "[SECRET" not in t[s[1] : s[2] + 8] for t in text.values() for s in spans(t))
    assert all(c.encode(text[r.doc_id]) == r.ids for r in seen["bpe"].limit(40).collect())


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "ids"] and out.count() > 100
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "secret_scan", "bpe"]


def test_rows_against_brute_force(spark, tmp_path):
    """run() on a small corpus with copies, items, secrets and toxic rows, against every stage written out plainly."""
    import random

    import test_decontaminate
    import test_ngram_join
    from tokenizers import Tokenizer

    from plumbline.llm import secrets as S
    from plumbline.llm import toxicity as T
    from plumbline.llm.common import fold

    r = random.Random(21)
    word = lambda: r.choice("lorem ipsum dolor sit amet elit sed tempor magna aliqua enim quis nostrud velit cillum nulla".split()) + r.choice("aeiou")
    items = [(i, " ".join(word() for _ in range(14))) for i in range(6)]
    rows, labels = [], []
    for i in range(160):
        w = [word() for _ in range(r.randint(20, 70))]
        if i % 6 == 0:
            w[5:5] = items[i % 5][1].split()
        if i % 5 == 1:
            w += ["password:", "Zq8" + word() + "xK#9", "token=abcdef123456"]
        if i % 7 == 2:
            w[3:3] = ["you", "idiot", "scum", "moron"] * 3
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(i % 7 == 2)))
    for i in range(60):
        w = r.choice(rows[:160])[1].split()
        for _ in range(r.choice([0, 1, 2, 6])):
            w[r.randrange(len(w))] = word()
        rows.append((200 + i, " ".join(w), "en", "s", 0))
    rows += [(500, None, "en", "s", 0), (501, "", None, "s", 0), (502, "tiny", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, df in (("documents", docs), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = {x.doc_id: x.ids for x in corpus_pipeline.run(spark, f"file://{tmp_path}").collect()}

    model = T.fit_toxicity(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), fold("doc_id", 3) != 1)
    score = {x.doc_id: x.score for x in T.toxicity_scores(spark, docs, model).collect()}
    left = [(i, t) for i, t, *_ in rows if score[i] < 0.7]
    assert 10 < len(rows) - len(left) < 80
    one = [(i, t) for (i, t) in left if next(c for d, _, c in test_ngram_join.brute(left) if d == i) == i]
    found = {d for d, _ in test_decontaminate.brute(one, items)}
    clean = [(i, t) for i, t in one if i not in found]
    assert len(left) > len(one) > len(clean) > 60
    words = {}
    for _, t in clean:
        for before, w in zip(["", *(t or "").split()], (t or "").split(), strict=False):
            if w.isalpha() and w.isascii() and 3 <= len(w) <= 24 and not before.endswith(":"):
                words[w.lower()] = words.get(w.lower(), 0) + 1
    top = [w for w, n in sorted(words.items(), key=lambda x: (-x[1], x[0])) if n > 1 and w not in S._RANK]
    rank = S._RANK | {w: k for k, w in enumerate(top, len(S._RANK) + 1)}
    library, marked = Tokenizer.from_file(tokenizer_path()), 0
    assert got.keys() == {i for i, _ in clean}
    for i, t in clean:
        text, cover = t or "", set()
        inside = [(a, b) for _, a, b in S.spans(text, rank=rank)]
        cover = {k for a, b in inside for k in range(a, b)}
        seams = {k for k in cover if k - 1 in cover and not any(a < k < b for a, b in inside)}  # spans that only touch
        starts = [k for k in cover if k - 1 not in cover or k in seams]
        text = "".join("[SECRET]" if k in starts else "" if k in cover else c for k, c in enumerate(text))
        marked += len(starts)
        assert got[i] == library.encode(text, add_special_tokens=False).ids
    assert marked > 10
