"""Joins within a page by cells and bands, against every pair of the page."""

import random

import pytest
from pyspark.sql import functions as F

from tagwright import reference_data as R
from tagwright.operators import linkage


def boxes(seed, n, pages=3, grid=1.0):
    rng = random.Random(seed)
    return [(f"f{k % 2}", k % pages, k, round(rng.uniform(-800, 800) / grid) * grid, round(rng.uniform(-300, 300) / grid) * grid) for k in range(n)]


@pytest.mark.parametrize(("dx", "dy", "inclusive"), [(R.FINANCING_DX, R.FINANCING_DY, True), (R.MEMBER_DX, R.MEMBER_DY, False)])
@pytest.mark.parametrize("grid", [0.5, 15.0])  # the coarse one has many distances of exactly the reach
def test_marks_by_cells(spark, dx, dy, inclusive, grid):
    tokens, marks = boxes(1, 400, grid=grid), boxes(2, 25, grid=grid)
    table = lambda rows: spark.createDataFrame(rows, "file string, page int, tok_id int, cx double, cy double").repartition(3)
    near = lambda t, m: t[:2] == m[:2] and ((abs(t[3] - m[3]) <= dx and abs(t[4] - m[4]) <= dy) if inclusive else (abs(t[3] - m[3]) < dx and abs(t[4] - m[4]) < dy))
    want = {t[2] for t in tokens if any(near(t, m) for m in marks)}
    semi = [r.tok_id for r in linkage.near_marks(table(tokens), table(marks), dx, dy, "left_semi", inclusive).collect()]
    anti = [r.tok_id for r in linkage.near_marks(table(tokens), table(marks), dx, dy, "left_anti", inclusive).collect()]
    assert sorted(semi) == sorted(want) and sorted(anti) == sorted({t[2] for t in tokens} - want) and 20 < len(want) < 380


def test_a_page_is_no_single_key(spark):
    """One page of 20,000 tokens and 2,000 marks: a token is compared with the marks around it."""
    rows = [("f", 1, k, 40.0 * (k % 500), 60.0 * (k // 500)) for k in range(20_000)]
    table = spark.createDataFrame(rows, "file string, page int, tok_id int, cx double, cy double")
    marks = table.where("tok_id % 10 = 0")
    cells = marks.select(F.explode(linkage._around(F.col("cx"), 301)).alias("gx"), "cy").select("gx", F.explode(linkage._around(F.col("cy"), 46)).alias("gy"))
    mine = table.select(linkage._cell(F.col("cx"), 301).alias("gx"), linkage._cell(F.col("cy"), 46).alias("gy"))
    # nine cells of 301 x 46 hold 5.2 marks where one lies every 400 x 60
    assert mine.join(cells, ["gx", "gy"]).count() < 6 * 20_000
    assert linkage.without_financing(table, marks).count() == 2 * 40  # the last two columns have no mark within 300


def test_chips_by_bands(spark):
    rng, rows = random.Random(3), []
    for k in range(600):
        text = rng.choice(["250", "77", "1234", "KG", "LITRES", "KILO", "GROSS", "NET-607L", "x"])
        x = rng.uniform(0, 600)
        rows.append((f"f{k % 2}", k % 3, k, text, x, x + rng.uniform(20, 80), float(rng.randrange(0, 500))))
    table = spark.createDataFrame(rows, "file string, page int, tok_id int, text string, x0 double, x1 double, y0 double").repartition(4)
    shared = lambda a, b: max(0.0, min(a[5], b[5]) - max(a[4], b[4]))
    want = {}
    for n in rows:
        if n[3].isdigit() and 2 <= len(n[3]) <= 4:
            units = [u for u in rows if u[3] in ("KG", "LITRES", "KILO") and u[:2] == n[:2] and shared(n, u) > 10 and 0 < u[6] - n[6] < 80]
            if units:
                u = max(units, key=lambda u: u[2])
                gross = any("GROSS" in g[3] and g[:2] == u[:2] and shared(g, u) > 0 and 0 < g[6] - u[6] < 60 for g in rows)
                want[n[2]] = n[3] + (" L" if u[3] == "LITRES" else " kg") + " gross" * gross
        elif n[3] == "NET-607L":
            want[n[2]] = "607 L net"
    got = {r.tok_id: r.chip for r in linkage.capacity_chips(table).collect()}
    assert got == want and sum("gross" in c for c in want.values()) > 3
