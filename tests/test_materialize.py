"""Queries over written study views equal the queries over the driver tables."""

import tempfile

import __spark_entry__ as se
from casebook.sources.materialize import STUDIES, load_materialized, materialize
from tests.conftest import SMALL

PREFIX = {"retail": "bt_", "diner": "dn_", "delivery": "pr_", "subscriptions": "ff_", "bank": "db_",
          "mart": "dm_", "funnel": "cb_"}


def test_materialized_views_give_the_same_answers(spark):
    out = tempfile.mkdtemp(prefix="casebook-views-")
    q = se.queries()
    for study in STUDIES:
        materialize(spark, SMALL, out, study)
        src = load_materialized(spark, out, study)
        for qid in [k for k in q if k.startswith(PREFIX[study])][:6]:
            a = sorted(map(tuple, q[qid](spark, SMALL).collect()), key=repr)
            b = sorted(map(tuple, q[qid](spark, src).collect()), key=repr)
            assert a == b, qid
