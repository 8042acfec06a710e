import random

import corpus_pipeline
from loamflow.llm import mixing, nbsvm, quality, secrets, stages, tiling
from loamflow.llm.common import keyed_text
from test_partenum import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, folder):
    """documents, labels and benchmark of a small corpus, written as the tables are."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghi") for _ in range(rnd.randint(2, 8)))
    bench = [(i, " ".join(word() for _ in range(25))) for i in range(4)]
    docs, labels = [], []
    for i in range(240):
        w = [word() for _ in range(rnd.randint(30, 90))]
        good = rnd.random() < 0.75
        if not good:
            w = [x + "%%%" if rnd.random() < 0.6 else x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w), "en", f"s{i % 5}", 0))
        labels.append((i, int(good), 0))
    good = [d for d, (_, q, _) in zip(docs, labels) if q]
    docs += [(300 + i, d[1] + " more", "en", "copies", 0) for i, d in enumerate(good[:8])]
    docs += [(400 + i, good[20 + i][1] + " " + b, "en", "leak", 0) for i, (_, b) in enumerate(bench)]
    docs += [(500, " ".join(word() for _ in range(60)) + " token = '0123456789abcdef0123456789abcdef'", "en", None, 0), (None, good[31][1] + " no id", "en", "x", 0)]
    docs += [docs[3], (600, None, "en", "x", None), (601, "", "en", "x", 0)]
    docs = [(i, t, x, s, None if t is None else len(t)) for i, t, x, s, _ in docs]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, bench


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_every_stage_against_its_definition(spark, run_dir):
    docs, bench = fixture(spark, run_dir)
    now = spark.read.parquet(f"{run_dir}/documents.parquet")
    names = now.columns

    one = stages.quality(spark, now, run_dir)
    texts = keyed_text(now)
    model = nbsvm.fit(texts, nbsvm.training_labels(spark.read.parquet(f"{run_dir}/labels.parquet"), "quality"), quality.features)
    scores = {(r.doc_id, r.text): s.score for r, s in zip(texts.collect(), nbsvm.score(texts, model, quality.features).collect())}
    kept = [d for d in docs if scores[d[0], d[1] or ""] >= quality.THRESHOLD]
    assert one.columns == names and rows(one) == sorted(map(str, kept)) and 150 < len(kept) < len(docs)

    two = stages.near_duplicates(spark, one, run_dir)
    comp = brute([(d[0], d[1]) for d in kept])
    least = {i for i, _, c in comp if i == c}
    want = sorted({str(d) for d in kept if str(d[0]) in least or d[0] is None})
    assert two.columns == names and rows(two) == want and len(want) < len(kept)

    three = stages.decontaminate(spark, two, run_dir)
    left = [d for d in two.collect() if not any(b in (d.text or "") for _, b in bench)]
    assert three.columns == names and rows(three) == sorted(str(tuple(d)) for d in left) and len(left) < two.count()

    four = stages.redact_secrets(spark, three, run_dir)
    assert four.columns == names and four.count() == three.count()
    assert all(secrets.find_secrets(r.text or "") == ([], []) and r.n_chars == (None if r.text is None else len(r.text)) for r in four.collect())
    assert len(set(rows(four)) - set(rows(three))) == 1

    five = stages.mix(spark, four, run_dir)
    assert rows(five) == rows(mixing.mix(four)) and five.count() == four.count()
    assert rows(corpus_pipeline.run(spark, run_dir)) == rows(five)


def test_stage_list():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "redact_secrets", "mix"]
    assert corpus_pipeline.ORACLE_SQL is None and tiling.THRESHOLD == 0.5
