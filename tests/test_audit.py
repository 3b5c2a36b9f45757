"""Draft gates and answer scoring on hand-written cases."""

import pytest

from creditweave.operators import audit

DRAFTS = [
    ("select count(*) from applications", "accepted", None, None),
    ("WITH x AS (select 1) select * from scored", "accepted", None, None),
    ("select * from cat.sch.declines f join applications a on a.id = f.id;", "accepted", None, None),
    ("select 1; drop table t", "refused", "single_statement", None),
    ("show tables", "refused", "read_only", None),
    ("selection from x", "refused", "read_only", None),
    ("select * from applications where note = 'drop it'", "refused", "forbidden_verb", "drop"),
    ("select a into t from applications", "refused", "forbidden_verb", "into"),
    ("with t as (select 1) select * from t", "refused", "table_allowlist", "t"),
    ("select * from secrets join applications", "refused", "table_allowlist", "secrets"),
    ("select * from applications a, secrets", "refused", "hidden_table", None),
    ("select * from `secrets`", "refused", "hidden_table", None),
    ("```sql\nselect 1\n```", "accepted", None, None),
    ("  ```SQL select 2;```", "accepted", None, None),
    ("select 3;;; ", "accepted", None, None),
    ("select created_at, updates from applications", "accepted", None, None),
    (None, "refused", None, None),
]


@pytest.fixture(scope="module")
def audited(spark):
    df = spark.createDataFrame([(i, d[0]) for i, d in enumerate(DRAFTS)], "question_id int, sql_text string")
    return {r["question_id"]: r for r in audit.audit_drafts(df).collect()}


@pytest.mark.parametrize("i", range(len(DRAFTS)))
def test_gates(audited, i):
    got = audited[i]
    assert (got["verdict"], got["gate"], got["detail"]) == DRAFTS[i][1:]


def test_clean_up(audited):
    assert audited[12]["cleaned_sql"] == "select 1"
    assert audited[13]["cleaned_sql"] == "select 2"
    assert audited[14]["cleaned_sql"] == "select 3"


def test_plain_gates_only(spark):
    df = spark.createDataFrame([(1, "select * from applications a, secrets")], "question_id int, sql_text string")
    assert audit.audit_drafts(df, strict=False).first()["verdict"] == "accepted"


def test_answers(spark):
    cases = [
        ("0.1234", "0.12345", False, True),
        ("0.1234", "0.1236", False, False),
        ("10", " 10.0 ", False, True),
        ("cash loans", " cash loans", False, True),
        ("cash loans", "Cash loans", False, False),
        ("1", "one", False, False),
        ("1", "1", True, False),
        ("1", None, False, False),
        (None, None, False, True),
        ("NaN", "NaN", False, False),
    ]
    truth = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)] + [(99, "5")], "question_id int, expected string")
    answers = spark.createDataFrame([(i, c[1], c[2]) for i, c in enumerate(cases)], "question_id int, got string, refused boolean")
    scored = audit.score_answers(answers, truth)
    got = {r["question_id"]: r["hit"] for r in scored.collect()}
    assert got == {**{i: c[3] for i, c in enumerate(cases)}, 99: False}
    assert tuple(audit.answer_accuracy(scored).first()) == (11, 4, 0.3636)
