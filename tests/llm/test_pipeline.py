"""Every stage of the pipeline against brute force on what the stage before kept."""

import random
from collections import Counter

import pytest
from test_decontaminate import brute as brute_hits
from test_line_dedup import brute as brute_lines
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from rowsmith.llm.sentencepiece_sampling import decode

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(8)
    part = ["ra", "mo", "ti", "lu", "ser", "an", "de", "il", "éa"]
    word = lambda: "".join(rng.choice(part) for _ in range(rng.randint(1, 4)))
    run = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(run(25))) for i in range(6)]
    common, texts, labels = " ".join(run(9)), [], []
    for i in range(400):
        w = run(rng.randint(30, 90))
        if i % 6 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grobble", "nurk", "zwick" + word()]))
        if i % 11 == 1:
            w[20:20] = rng.choice(items)[1].split()[4:18]
        cut = rng.randrange(5, len(w) - 5)
        labels.append((i, 1, int(i % 6 == 0)))
        texts.append(" ".join(w[:cut]) + "\n" + " ".join(w[cut:]) + ("\n" + common if i % 2 else ""))
    base = texts[7].split(" ")
    for i in range(60):  # near copies and copies
        near = list(base)
        near[rng.randrange(len(near))] = word()
        texts.append(" ".join(near) if i % 2 else texts[13])
    texts += [None, "", "\n \n", "lone", "ra " * 30000]
    rows = [(i, t, "xx", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[9], None, None, 5), (None, " ".join(run(50)), None, None, None)]
    out = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_stages_match_brute_force(spark, sf_dir, tmp_path):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "sentencepiece"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        after = [tuple(r) for r in out.collect()]
        if name != "sentencepiece":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        if name == "toxicity":
            bad = lambda t: any(w.startswith(("grobble", "nurk", "zwick")) for w in (t or "").split())
            assert Counter(after) == Counter(r for r in before if not bad(r[1]))
        elif name == "line_dedup":
            want = Counter()
            for (d, _, _, text), n in brute_lines(before).items():
                want[d, text] += n
            assert Counter((r[0], r[1] or "") for r in after) == want
            assert all(r[4] == (None if r[1] is None else len(r[1])) for r in after)
            assert Counter((r[0], *r[2:4]) for r in after) == Counter((r[0], *r[2:4]) for r in before)
        elif name == "simhash_dedup":
            distinct = sorted(set(before), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
            groups = brute_components([brute_fingerprint(r[1]) for r in distinct], 3)
            least = {}
            for r, g in zip(distinct, groups, strict=True):
                least.setdefault(g, r[0])
            want = [r for r, g in zip(distinct, groups, strict=True) if r[0] == least[g]]
            assert Counter(after) == Counter(want)
            assert len(after) < len(before) - 10
        elif name == "decontamination":
            hit = {(d, n): bool(h) for (d, n, h, *_) in brute_hits(before, items, 10)}
            clean = [r for r in before if not next(iter(brute_hits([r], items, 10)))[5]]
            assert Counter(after) == Counter(clean) and len(clean) < len(before) and any(hit.values())
        else:
            back = decode(out, out_col="back").collect()
            assert Counter((r.doc_id, r.back) for r in back) == Counter((r[0], r[1] or "") for r in before)
            assert all(r.lossless for r in back)
        docs, before = out, after
    ran = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in ran) == Counter((r[0], tuple(r[1])) for r in before)


def test_stages_on_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_with_clashing_names_pass_through(spark, sf_dir, tmp_path):
    names = ["id", "fp", "key", "label", "score", "kept", "unit", "node", "id_key", "kept_numbers", "copy_number", "row_key", "segment", "n_words"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", *[f"concat('{n}', doc_id) AS {n}" for n in names])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "sentencepiece":
            own = [n for n in names if docs.where(f"NOT {n} <=> concat('{n}', doc_id)").count()]
            assert docs.count() and not own
    ran = corpus_pipeline.run(spark, sf_dir)
    assert {tuple(r.ids) for r in ran.collect()} == {tuple(r.ids) for r in docs.collect()}
