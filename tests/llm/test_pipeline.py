"""The pipeline against a plain version of each stage."""

import collections
import random

import corpus_pipeline
from tallyloom.llm import toxicity

from test_dedup_and_joins import brute_components, near_copies, normal
from test_scans_and_mix import brute_contamination, fill_by_turns


def test_stages_equal_plain_ones(spark, make_docs, tmp_path):
    rng = random.Random(12)
    rows = [(i, t, "en", rng.choice(["a", "b", None])) for i, t, *_ in near_copies(3, families=8, size=6)]
    rows += [(500 + k, rows[k][1].replace(" ", "  "), "en", "a") for k in range(10)]
    items = [(k, " ".join(f"q{rng.randrange(90)}" for _ in range(14))) for k in range(4)]
    rows += [(600 + k, f"start of it {items[k][1]} and more of it", "en", "b") for k in range(4)]
    chatter = lambda n: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(n))
    bad = [(700 + k, f"{chatter(6)} hateful badword {chatter(9)}", "en", "a") for k in range(30)]
    good = [(800 + k, chatter(30), "en", "b") for k in range(30)]
    rows += bad + good + [(900, None, None, None), (901, "", "en", "a")]
    folder = str(tmp_path)
    make_docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    # Clean labels cover every kind of clean text, so that none of them stands out as unknown.
    labels = [(r[0], 1, 1) for r in bad[:20]] + [(r[0], 1, 0) for r in rows if r[0] < 700] + [(r[0], 1, 0) for r in good[:20]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "ngram_join", "decontamination", "source_mix"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, kept, folder).write.parquet(path)
        before = [(r.doc_id, r.text, r.lang, r.source) for r in kept.collect()]
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
        after = sorted(r.doc_id for r in kept.collect())
        if name == "toxicity":
            chain = toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            toxic = {r.doc_id for r in toxicity.score(docs, chain).where("toxic").collect()}
            assert {r[0] for r in bad} <= toxic and toxic <= {r[0] for r in bad}
            expected = [r[0] for r in before if r[0] not in toxic]
        elif name == "exact_dedup":
            first = {}
            for r in before:
                first[normal(r[1])] = min(r[0], first.get(normal(r[1]), r[0]))
            expected = first.values()
        elif name == "ngram_join":
            expected = {c for _, _, c in brute_components(before)}
        else:
            expected = [e[0] for e in brute_contamination(before, items) if not e[-1]]
        assert after == sorted(expected), name
    mixed = corpus_pipeline.run(spark, folder).collect()
    size = collections.Counter()
    for r in kept.collect():
        size[r.source] += len((r.text or "").split())
    order = sorted(s for s in size if s is not None) + [s for s in size if s is None]
    targets = dict(zip(order, fill_by_turns([size[s] for s in order], [5, 2, 1][: len(order)])))
    taken = collections.Counter()
    for r in mixed:
        taken[r.source] += r.mix_taken
        assert 0 < r.mix_taken <= 3 * r.mix_size
    assert all(abs(taken[s] - targets[s]) <= 1.001 for s in order)
