"""The pipeline: every stage against the operators' brute-force versions, and whole texts end to end."""

import hashlib
import random

import sentencepiece
from test_joins import components, jaccard_brute, line_brute

import __spark_entry__
import corpus_pipeline
from itemflow.llm.queries import tokenizer_path


def kept_by_brute_force(texts):
    """Ids and texts after line dedup and near-duplicate join, of texts that pass the quality rules."""
    gone = line_brute(texts)
    left = {}
    for i, t in enumerate(texts):
        out = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in set(gone.get(i, ())))
        if out.split() or i not in gone:
            left[i] = out
    ids = sorted(left)
    found = jaccard_brute([left[i] for i in ids])
    return {i: left[i] for k, i in enumerate(ids) if found[k][1] == k}


def test_pipeline_against_brute_force(spark, tmp_path):
    line = lambda s, n: " ".join(f"{s}{k * 7919 % 1000:03d}" for k in range(n)) + "."
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    texts = [
        line("a", 60), line("a", 60), line("a", 59) + "\n" + line("b", 60), line("c", 60) + "\n" + line("d", 8),
        line("e", 70) + " " + item + ".", line("f", 55) + "\n" + line("d", 8), line("a", 60).replace("a000", "zzz"),
    ]
    bad = [None, "", "too short.", "menu | here | now |\n" * 30, "same words again.\n" * 60]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*texts, *bad])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {i: t.replace(item, " ") for i, t in kept_by_brute_force(texts).items()}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(want)
    for i, text in want.items():
        ids = [*library.encode(text), 2]
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).dtypes == docs.dtypes


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


#: Tests of the queries that SQL cannot express: brute force, the libraries, round trips or held-out accuracy.
TESTED_BY = {
    "op1_sharding": "test_models.py", "op4_language_id": "test_models.py", "op9_toxicity": "test_models.py", "op10_url_rules": "test_models.py",
    "op5_sentencepiece": "test_texts.py", "op7_token_counts": "test_texts.py", "op6_line_dedup": "test_joins.py", "op8_jaccard_join": "test_joins.py",
    "op12_token_files": "test_tokens_manifest.py", "op13_token_align": "test_tokens_manifest.py", "pipeline": "test_pipeline.py",
}


def test_every_query_has_sql_or_a_test_of_its_own():
    own = {n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"} - set(__spark_entry__.oracle_sql())
    assert own == set(TESTED_BY)


def test_copies_with_short_lines_leave_no_fragment(spark):
    """Neither an exact copy nor near ones whose short lines differ go on; a line that such a one had first stays elsewhere."""
    line = lambda s, n: " ".join(f"{s}{k * 7919 % 1000:03d}" for k in range(n)) + "."
    short = lambda s, n: "\n".join(f"{s}{k} {k}." for k in range(n))
    texts = [
        line("a", 60) + "\nHaanth.", line("a", 60) + "\nHaanth.", line("a", 60) + "\nGol.",
        line("a", 60) + "\n" + line("b", 20), line("c", 60) + "\n" + line("b", 20),
        line("d", 200), line("d", 200) + "\n" + short("e", 40), short("f", 60) + "\nGol.",
        line("c", 60) + "\n" + line("g", 55), line("h", 20),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(corpus_pipeline.line_dedup(spark, docs, "").collect())
    assert got == {0: texts[0], 4: texts[4], 5: texts[5], 7: texts[7], 8: line("g", 55), 9: texts[9]}


def test_near_duplicates_are_those_of_five_words_and_four_fifths(spark):
    """Against brute force, with edits that lie apart (0.8 to 0.84 at five words is under 0.9 at three) and together."""
    draw = random.Random(6)
    texts = []
    for edits in [0, 1, 2, 3, 4, 5, 6, 8] * 3:
        base = [f"w{draw.randrange(10**6)}" for _ in range(200)]
        copy = list(base)
        at = [k * 23 + 9 for k in range(edits)] if len(texts) % 4 else range(50, 50 + 3 * edits)
        for k in at:
            copy[k] = f"x{draw.randrange(10**6)}"
        texts += [" ".join(base), " ".join(copy)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    found = components(links, range(len(sets)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == [i for i in found if found[i] == i]
    assert got != [i for i, (_, least) in jaccard_brute(texts).items() if i == least]
