import random
import re

import duckdb

from llm_cases import awkward, empty
from planpulse.llm import queries, rules

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_counts_match_brute_force(spark):
    rng = random.Random(4)
    many = []
    for _ in range(80):
        block = [rng.choice(["aa", "b#", "the", "ü|", "!", "\n", "\t", "X"]) for _ in range(rng.randint(0, 30))]
        many.append(rng.choice([" ", "  ", "\n"]).join(block * rng.randint(1, 4) + [str(rng.random())] * rng.randint(0, 3)))
    many += [None, "", " \n\x0b", "w " * 500, "a b c d e f g h i " * 3, "\r\nx\r\nx\n"]
    df = spark.createDataFrame(list(enumerate(many)), "doc_id bigint, text string")
    for r in rules.quality_rules(df).collect():
        assert tuple(r[c] for c in NAMES) == brute(many[r.doc_id]), many[r.doc_id]
        assert not (r.kept and r.base_failed)


def test_awkward_rows(spark):
    df = awkward(spark)
    got = sorted(((r.doc_id, *(r[c] for c in NAMES)) for r in rules.quality_rules(df).collect()), key=repr)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in df.collect()), key=repr)
    assert rules.quality_rules(empty(spark)).collect() == []


def test_order_is_by_rejections_per_cost_and_keeps_the_verdict(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    order = rules.order_rules(df, rules.RULES)
    assert sorted(r.name for r in order) == sorted(r.name for r in rules.RULES)
    counted = rules.base_counts(df)
    verdicts = [sorted((r.doc_id, r.rejected_by is None) for r in rules.cascade(counted, o).collect())
                for o in (order, order[::-1], rules.RULES)]
    assert verdicts[0] == verdicts[1] == verdicts[2]


def test_later_rules_are_not_evaluated(spark):
    """A rule that would fail the job is never reached by documents that an earlier rule rejects."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "### " * 100), (2, "### ab " * 60)], "doc_id bigint, text string")
    df = df.withColumn("text", F.concat("text", F.lit(" ".join(f"w{i}" for i in range(900)))))
    trap = rules.Rule("trap", lambda: F.raise_error(F.lit("reached")).cast("boolean"))
    symbols = rules.Rule("symbols", lambda: F.col("n_symbols") > 100)
    rows = rules.cascade(rules.base_counts(df), [symbols, trap]).select("rejected_by").collect()
    assert {r.rejected_by for r in rows} == {"symbols"}


def test_clean_documents_stay(spark):
    got = {r.doc_id: r for r in queries.op2_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    clean = [r for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    junk = [r for r in labels if r.quality == 0]
    assert sum(got[r.doc_id].kept for r in clean) / len(clean) > 0.99
    assert sum(got[r.doc_id].kept for r in junk) / len(junk) < 0.1


def test_query_matches_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    names = ["doc_id", *NAMES, "kept"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLE_SQL['op2_quality_rules']})").fetchall()
    df = queries.op2_quality_rules(spark, d)
    assert df.columns == names
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_no_python_in_the_plan(spark):
    plan = rules.quality_rules(awkward(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
