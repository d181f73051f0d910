"""Ties between all pages of a node, without a row for each tie."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import joins as J
from plumbline.operators import kernels as K
from plumbline.plans import catalog


@pytest.mark.parametrize("extra", [(0.0, 0.0), (0.5, 1.0)])
def test_shifts_and_rms_equal_those_of_all_ties(spark, extra):
    r = random.Random(3)
    uses = [(f"n{n}", p, r.randrange(9), r.uniform(0, 50), r.uniform(0, 50)) for n in range(12) for p in r.sample(range(30), r.choice([1, 2, 9, 25])) for _ in range(2)]
    uses += [(None, 1, 0, 7.0, 7.0), ("n1", None, 0, 7.0, 7.0)]
    u = spark.createDataFrame(uses, "node string, page int, ord int, px double, py double")
    v = F.pmod(F.crc32("node"), F.lit(3)).alias("v")
    gaps = [(F.col(f"p{c}_b") - F.col(f"p{c}_a") + e).alias(f"gap_{c}") for c, e in zip("xy", extra, strict=True)]
    ties = J.seam_ties(u).select(v, "page_a", "page_b", *gaps)
    first = J.first_uses(u).select(v, "*")
    want = {(x.v, x.page): (x.dx, x.dy) for x in K.seam_solve(ties, "v").collect()}
    got = {(x.v, x.page): (x.dx, x.dy) for x in K.shared_seam_solve(first, "v", extra=extra).collect()}
    assert set(got) == set(want) and np.allclose([got[k] for k in want], list(want.values()), atol=1e-9)
    square = lambda c: F.sqrt(F.avg(F.col(c) ** 2)).alias(c)
    want = {x.v: x[1:] for x in J.seam_mismatches(ties, K.seam_solve(ties, "v"), "v").groupBy("v").agg(F.count(F.lit(1)), square("before"), square("after")).collect()}
    got = {x.v: x[1:] for x in K.shared_seam_rms(first, "v", extra=extra).collect()}
    assert set(got) == set(want) and np.allclose([got[k] for k in want], list(want.values()), atol=1e-9)


@pytest.mark.parametrize("name", ["seam_solve", "seam_mismatches"])
def test_queries_join_no_pages(spark, sf_dir, name):
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
