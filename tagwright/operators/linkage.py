"""Tokens placed on a page to product rows.

Tokens: file, page, tok_id, text, conf, x0, y0, x1, y1; y grows downward and
tok_id is the reading order of the page. All joins are within a page, so they
share one partitioning by (file, page).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType
from pyspark.sql.window import Window

from tagwright import reference_data as R
from tagwright.functions.prices import rescued_price, resolve_prices
from tagwright.functions.text import bound, capacity, flag, flags, is_code_shaped, is_strong_code, normalize_code, percents, price_value, stripped
from tagwright.operators.catalog import code_metadata
from tagwright.operators.matching import match
from tagwright.sources.staging import keep

PAGE = ["file", "page"]
#: Height of the bands by which numbers, unit words and their marks meet: more than they may be apart.
CHIP_BAND = 81.0
#: Pages that are folded at once, times the tokens of the longest.
FOLD_CELLS = 1 << 20


def placed(tokens: DataFrame) -> DataFrame:
    """tokens with text stripped and center cx, cy; blank ones are dropped."""
    centers = {"text": stripped(F.col("text")), "cx": (F.col("x0") + F.col("x1")) / 2, "cy": (F.col("y0") + F.col("y1")) / 2}
    return tokens.withColumns(centers).where("text <> ''")


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def expand_glued(tokens: DataFrame) -> DataFrame:
    """Glued price tokens become single ones, with part (0, 1) in their order; freebie values go."""
    text, middle = F.col("text"), (F.col("x0") + F.col("x1")) / 2
    piece = lambda part, t, a, b: F.struct(F.lit(part).alias("part"), t.alias("text"), a.cast("double").alias("x0"), b.cast("double").alias("x1"))
    x0, x1 = F.col("x0"), F.col("x1")
    was = F.regexp_extract(text, R.GLUED_WAS, 1)
    pieces = (
        F.when(was != "", F.array(piece(0, was, x0, x1)))
        .when(text.rlike(R.GLUED_PAIR), F.array(piece(0, F.regexp_extract(text, R.GLUED_PAIR, 1), x0, middle), piece(1, F.regexp_extract(text, R.GLUED_PAIR, 2), middle, x1)))
        .otherwise(F.array(piece(0, text, x0, x1)))
    )
    out = tokens.where(~text.rlike(R.FREEBIE)).withColumn("_p", F.explode(pieces))
    out = out.withColumns({"part": F.col("_p.part"), "text": F.col("_p.text"), "x0": F.col("_p.x0"), "x1": F.col("_p.x1")}).drop("_p")
    return out.withColumn("cx", (F.col("x0") + F.col("x1")) / 2)


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size)


def _around(c: Column, size: float, before: int = 1, after: int = 1) -> Column:
    """Cells that hold everything within a size of c: the key of an equi-join in place of a page as a whole."""
    return F.sequence(_cell(c, size) - before, _cell(c, size) + after)


def near_marks(tokens: DataFrame, marks: DataFrame, dx: float, dy: float, how: str, inclusive: bool) -> DataFrame:
    """tokens with (left_semi) or without (left_anti) a mark of their page that near.

    They meet by cells of a grid over the page, a little larger than the reach,
    so a page of very many tokens is no single key: each token meets the marks
    of its neighbourhood.
    """
    wide, high = dx + 1, dy + 1
    m = marks.select(*[F.col(c).alias(f"_{c}") for c in PAGE], F.col("cx").alias("_cx"), F.col("cy").alias("_cy"))
    m = m.withColumn("_gx", F.explode(_around(F.col("_cx"), wide))).withColumn("_gy", F.explode(_around(F.col("_cy"), high)))
    off_x, off_y = F.abs(F.col("cx") - F.col("_cx")), F.abs(F.col("cy") - F.col("_cy"))
    band = (off_x <= dx) & (off_y <= dy) if inclusive else (off_x < dx) & (off_y < dy)
    here = (F.col("file") == F.col("_file")) & (F.col("page") == F.col("_page")) & (_cell(F.col("cx"), wide) == F.col("_gx")) & (_cell(F.col("cy"), high) == F.col("_gy"))
    return tokens.join(m, here & band, how)


def without_financing(tokens: DataFrame, marks: DataFrame) -> DataFrame:
    return near_marks(tokens, marks, R.FINANCING_DX, R.FINANCING_DY, "left_anti", True)


def member_prices(tokens: DataFrame, marks: DataFrame) -> DataFrame:
    return near_marks(tokens, marks, R.MEMBER_DX, R.MEMBER_DY, "left_semi", False)


def capacity_chips(tokens: DataFrame) -> DataFrame:
    """file, page, tok_id, chip: a number over a unit word, or a glued NET/GROSS chip. They meet by bands of the page's height."""
    numbers_at, gross_at = _cell(F.col("y0"), CHIP_BAND).alias("_g"), F.explode(_around(F.col("y0"), CHIP_BAND, 1, 0)).alias("_h")
    units = tokens.where(F.col("text").rlike(R.UNIT_WORD)).select(*PAGE, *[F.col(c).alias(f"u_{c}") for c in ("tok_id", "text", "x0", "x1", "y0")])
    units = units.withColumn("_h", _cell(F.col("u_y0"), CHIP_BAND))
    numbers = tokens.where(F.col("text").rlike(r"^\d{2,4}$")).select(*PAGE, "tok_id", "text", "x0", "x1", "y0", numbers_at)
    over = (overlap(F.col("x0"), F.col("x1"), F.col("u_x0"), F.col("u_x1")) > 10) & (F.col("u_y0") - F.col("y0") > 0) & (F.col("u_y0") - F.col("y0") < 80)
    gross = tokens.where(F.upper("text").contains("GROSS")).select(*PAGE, *[F.col(c).alias(f"g_{c}") for c in ("x0", "x1", "y0")], gross_at)
    under = (overlap(F.col("g_x0"), F.col("g_x1"), F.col("u_x0"), F.col("u_x1")) > 0) & (F.col("g_y0") - F.col("u_y0") > 0) & (F.col("g_y0") - F.col("u_y0") < 60)
    marked = units.join(gross, [*PAGE, "_h"]).where(under).select(*PAGE, "u_tok_id").distinct().withColumn("_gross", F.lit(" gross"))
    unit = F.when(F.upper("u_text").rlike("^(KG|KILO)"), " kg").otherwise(" L")
    above = units.withColumn("_g", F.explode(F.sequence(F.col("_h") - 1, F.col("_h"))))
    pairs = numbers.join(above, [*PAGE, "_g"]).where(over).join(marked, [*PAGE, "u_tok_id"], "left")
    stacked = pairs.select(*PAGE, "tok_id", F.col("u_tok_id").alias("_rank"), F.concat("text", unit, F.coalesce("_gross", F.lit(""))).alias("chip"))
    net = F.when(F.upper("text").startswith("NET"), " net").otherwise(" gross")
    glued = tokens.where(F.col("text").rlike(R.NET_CHIP)).select(*PAGE, "tok_id", F.lit(1 << 40).alias("_rank"), F.concat(F.regexp_extract("text", R.NET_CHIP, 2), F.lit(" L"), net).alias("chip"))
    return stacked.unionByName(glued).groupBy(*PAGE, "tok_id").agg(F.max_by("chip", "_rank").alias("chip"))


def bears_on_prices(text: Column) -> Column:
    """Whether a token can be a price, or be what keeps one from being a price: all that capacity_chips and price_tokens look at."""
    kinds = (R.PRICE_TOKEN, R.PERCENT_TOKEN, R.GLUED_WAS, R.GLUED_PAIR, R.FINANCING, R.UNIT_WORD, R.NET_CHIP, r"^\d{2,4}$")
    return bound(text, lambda t: reduce(or_, [t.rlike(k) for k in kinds]) | F.upper(t).contains("GROSS"))


def price_tokens(tokens: DataFrame, chips: DataFrame) -> DataFrame:
    """Price and percent tokens that are neither financing nor capacity chips."""
    marks = tokens.where(F.col("text").rlike(R.FINANCING))
    shaped = expand_glued(tokens).where(F.col("text").rlike(R.PRICE_TOKEN) | F.col("text").rlike(R.PERCENT_TOKEN))  # before the joins, which then move fewer rows
    return without_financing(shaped.join(chips.select(*PAGE, "tok_id"), [*PAGE, "tok_id"], "left_anti"), marks)


def cluster_numbers(xs: np.ndarray, ys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Cluster of each token, its centers given page after page (bounds). A step takes the next token of every page; pages of like length go together."""
    lengths = np.diff(bounds)
    out, order, done = np.zeros(len(xs), np.int32), np.argsort(-lengths, kind="stable"), 0
    while done < len(order) and lengths[order[done]]:
        longest = int(lengths[order[done]])
        pages = order[done : done + max(1, FOLD_CELLS // longest)]
        done += len(pages)
        begin, n, made = bounds[pages], lengths[pages], np.zeros(len(pages), np.int64)
        sums = np.zeros((3, len(pages), min(longest + 1, 8)))  # x, y, tokens; the first cluster that is not there yet is 0 / 0, which is near nothing
        for step in range(longest):
            here = int(np.searchsorted(-n, -step))
            at, rows, width = begin[:here] + step, np.arange(here), int(made[:here].max()) + 1
            if width > sums.shape[2]:
                sums = np.concatenate([sums, np.zeros_like(sums)], 2)
            token = np.stack([xs[at], ys[at], np.ones(here)])
            known = sums[:, :here, :width]
            with np.errstate(invalid="ignore"):
                near = (np.abs(token[0][:, None] - known[0] / known[2]) <= R.CLUSTER_DX) & (np.abs(token[1][:, None] - known[1] / known[2]) <= R.CLUSTER_DY)
            spot = np.where(near.any(1), near.argmax(1), made[:here])
            made[:here] += spot == made[:here]
            sums[:, rows, spot] += token
            out[at] = spot
    return out


@F.arrow_udf(ArrayType(IntegerType()))
def _page_clusters(xs: pa.Array, ys: pa.Array) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(xs).to_numpy(zero_copy_only=False))]).astype(np.int64)
    x, y = (c.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in (xs, ys))
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(cluster_numbers(x, y, bounds)))


def price_clusters(prices: DataFrame) -> DataFrame:
    """prices with cluster and price. Each token in turn joins the first cluster whose mean center is near, or begins one; the means move, so a page is folded in order."""
    rest = [c for c in prices.columns if c not in PAGE]
    order = ["tok_id", "part", *[c for c in rest if c not in ("tok_id", "part")]]
    pages = prices.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_t"))
    center = lambda c: F.transform("_t", lambda t: t[c].cast("double"))
    folded = pages.withColumn("_n", _page_clusters(center("cx"), center("cy")))
    found = folded.select(*PAGE, F.explode(F.arrays_zip("_t", "_n")).alias("_z")).select(*PAGE, "_z._t.*", F.col("_z._n").alias("cluster"))
    return found.select(*prices.columns, "cluster").withColumn("price", price_value(F.col("text")))


def cluster_table(clustered: DataFrame) -> DataFrame:
    """A row for each cluster with a price: center, x-range, strength, its tokens in order."""
    glyph = F.col("text").rlike("^[A-Za-z]") & F.col("price").isNotNull()
    n, percent = F.count("price"), F.bool_or(F.col("text").rlike(R.PERCENT_TOKEN))
    tokens = F.array_sort(F.collect_list(F.struct("tok_id", "part", "text", "conf", "cx", "cy", "price")))
    table = clustered.groupBy(*PAGE, "cluster").agg(
        F.avg("cx").alias("cl_cx"), F.avg("cy").alias("cl_cy"), F.min("x0").alias("cl_x0"), F.max("x1").alias("cl_x1"),
        ((n >= 2) | ((n >= 1) & (percent | F.bool_or(glyph)))).alias("strong"), n.alias("n_prices"), tokens.alias("tokens"),
    )
    return table.where("n_prices > 0")


def cluster_values(table: DataFrame, member_marks: DataFrame) -> DataFrame:
    """table with prices, percents, glyph, members and notes (flags).

    Prices of low confidence are kept apart. If one of them lies between a
    higher and a lower clear price, the lowest price below it is the member
    price, and its own is looked for in its digits.
    """
    spots = table.select(*PAGE, "cluster", F.explode("tokens").alias("t")).select(*PAGE, "cluster", "t.*")
    clear = spots.where(F.col("price").isNotNull() & (F.col("conf") >= R.CLEAR_CONF))
    members = member_prices(clear, member_marks).groupBy(*PAGE, "cluster").agg(F.collect_list("price").alias("members"))
    none = F.array().cast("array<double>")
    table = table.join(members, [*PAGE, "cluster"], "left").withColumn("members", F.coalesce("members", none))
    priced = F.filter("tokens", lambda t: t["price"].isNotNull())
    clear = F.filter(priced, lambda t: t["conf"] >= R.CLEAR_CONF)
    table = table.withColumns({"_clear": clear, "_garble": F.get(F.filter(priced, lambda t: t["conf"] < R.CLEAR_CONF), 0)})
    value = lambda c: F.transform(c, lambda t: t["price"])
    was = F.array_max(value(F.filter("_clear", lambda t: t["cy"] < F.col("_garble.cy"))))
    member = F.array_min(value(F.filter("_clear", lambda t: t["cy"] > F.col("_garble.cy"))))
    stacked = F.col("_garble").isNotNull() & (F.size("members") == 0) & (F.size("_clear") >= 2) & F.coalesce(member < was, F.lit(False))
    table = table.withColumns({"_stacked": stacked, "_was": was, "_below": member})
    table = table.withColumn("_rescued", F.when(F.col("_stacked"), rescued_price(F.col("_garble.text"), F.col("_below"), F.col("_was"))))
    quoted = F.concat(F.lit("'"), F.col("_garble.text"), F.lit("'"))
    has = F.col("_rescued").isNotNull()
    shown = F.regexp_replace(F.col("_rescued").cast("string"), r"\.0$", "")
    notes = flags(
        (F.col("_stacked") & has, flag("rescued", "restored the price ", shown, " from the unclear token ", quoted, ", read with ", F.round("_garble.conf", 2).cast("string"))),
        (F.col("_stacked") & ~has, flag("unreadable", "could not restore a price from the unclear token ", quoted, "; the others stay")),
    )
    return table.withColumns(
        {
            "prices": F.concat(value("_clear"), F.when(has, F.array("_rescued")).otherwise(none)),
            "percents": percents(F.array_join(F.transform("tokens", lambda t: t["text"]), " ")),
            "glyph": F.exists("_clear", lambda t: t["text"].rlike("^[A-Za-z]")),
            "members": F.when(F.col("_stacked"), F.array("_below")).otherwise(F.col("members")),
            "notes": notes,
        }
    ).drop("_clear", "_garble", "_stacked", "_was", "_below", "_rescued")


def model_codes(tokens: DataFrame, catalog: DataFrame) -> DataFrame:
    """tok_id with norm and its match: the first word of a token that matches or is code-shaped enough to report. Only the latter are told their nearest stems."""
    candidates = tokens.where(F.col("text").rlike(r"\d") & ~F.col("text").rlike(r"^\d+$"))  # no word of another token is code-shaped
    norms = F.transform(F.split("text", r"\s+"), lambda w, k: F.struct(k.alias("pos"), normalize_code(w).alias("norm")))
    shaped = F.filter(norms, lambda w: is_code_shaped(w["norm"])).alias("_words")
    # written, so that words are made once and not again for each step, and only their tokens are joined
    spots = keep(candidates.select(*PAGE, "tok_id", "cx", "cy", "x0", "x1", shaped).where(F.size("_words") > 0), "page-words")
    words = spots.select(*PAGE, "tok_id", F.explode("_words").alias("_w")).select(*PAGE, "tok_id", "_w.*")
    known = match(words.select("norm").distinct(), catalog, is_strong_code(F.col("norm")))
    ended = words.join(known.where(F.col("matched_code").isNotNull() | is_strong_code(F.col("norm"))), "norm")
    first = F.min_by(F.struct("norm", "matched_code", "confidence", "flag", "best_guess"), "pos").alias("m")
    found = ended.groupBy(*PAGE, "tok_id").agg(first).select(*PAGE, "tok_id", "m.*")
    return found.join(spots.drop("_words"), [*PAGE, "tok_id"])


def column_islands(points: DataFrame, x: str, gap: float = R.COLUMN_GAP) -> DataFrame:
    """points with island: a new one wherever the gap to the previous x of the page exceeds gap."""
    along = Window.partitionBy(*PAGE).orderBy(x)
    apart = F.coalesce((F.col(x) - F.lag(x).over(along) > gap).cast("int"), F.lit(0))
    return points.withColumn("_apart", apart).withColumn("island", F.sum("_apart").over(along)).drop("_apart")


def column_pools(codes: DataFrame, clusters: DataFrame) -> DataFrame:
    """file, page, tok_id, cluster: clusters of the column that pairs with a code's, on pages where both have as many columns, two or more."""
    columns = lambda df, x: column_islands(df, x).groupBy(*PAGE, "island").agg(F.avg(x).alias("center"), (F.max(x) - F.min(x)).alias("width"))
    code_columns, cluster_columns = keep(columns(codes, "cx"), "code-columns"), keep(columns(clusters, "cl_cx"), "cluster-columns")
    count = lambda df, name: df.groupBy(*PAGE).agg(F.count(F.lit(1)).alias(name))
    paired = count(code_columns, "_a").join(count(cluster_columns, "_b"), PAGE).where("_a = _b and _a >= 2").select(*PAGE)
    nearest = F.min_by("island", F.struct(F.abs(F.col("center") - F.col("cx")), "island")).alias("island")
    mine = codes.join(paired, PAGE).join(code_columns, PAGE).groupBy(*PAGE, "tok_id").agg(nearest)
    reach = 0.6 * (F.col("width") + R.COLUMN_GAP)
    spans = mine.join(cluster_columns, [*PAGE, "island"]).select(*PAGE, "tok_id", (F.col("center") - reach).alias("_lo"), (F.col("center") + reach).alias("_hi"))
    return spans.join(clusters.select(*PAGE, "cluster", "cl_cx"), PAGE).where("cl_cx between _lo and _hi").select(*PAGE, "tok_id", "cluster")


def _chosen(items: Column) -> Column:
    """struct(cluster, weak) of one code's clusters (sorted by dx, cluster), null if there are none."""

    def among(some: Column, weak: Column) -> Column:
        best = F.array_max(F.transform(some, lambda i: i["over"]))
        shared = F.filter(some, lambda i: i["over"] > 0.6 * best)
        by_overlap = F.array_min(F.transform(shared, lambda i: F.struct(i["dy"], i["cluster"])))["cluster"]
        closer = lambda nearest, i: F.when((i["dx"] - nearest["dx"] <= R.TIE_DX) & (i["dy"] < nearest["dy"]), i).otherwise(nearest)
        by_column = F.aggregate(F.slice(some, 2, 1 << 20), F.get(some, 0), closer)["cluster"]
        return F.struct(F.when(best > 30, by_overlap).otherwise(by_column).alias("cluster"), weak.alias("weak"))

    strong = F.filter(items, lambda i: i["strong"])
    return F.when(F.size(strong) > 0, bound(strong, lambda some: among(some, F.lit(False)))).when(F.size(items) > 0, among(items, F.lit(True)))


def link(pairs: DataFrame, pools: DataFrame | None = None) -> DataFrame:
    """file, page, tok_id, cluster, weak: the cluster of each code.

    pairs: code (cx, cy, t_x0, t_x1: range of the tile) with clusters of its page
    on the right side of it and near enough. Strong clusters go first; then
    those that overlap the tile, the vertically nearest; else the nearest by
    column, ties within a few pixels to the vertically nearest. pools (file,
    page, tok_id, cluster): clusters among which a code is linked if it has any
    of them.
    """
    if pools is None:
        pairs = pairs.withColumn("_pooled", F.lit(False))
    else:
        pairs = pairs.join(pools.select(*PAGE, "tok_id", "cluster", F.lit(True).alias("_pooled")), [*PAGE, "tok_id", "cluster"], "left")
    over = overlap(F.col("t_x0"), F.col("t_x1"), F.col("cl_x0"), F.col("cl_x1"))
    item = F.struct(F.abs(F.col("cl_cx") - F.col("cx")).alias("dx"), "cluster", F.abs(F.col("cy") - F.col("cl_cy")).alias("dy"), over.alias("over"), "strong", "_pooled")
    per = pairs.groupBy(*PAGE, "tok_id").agg(F.array_sort(F.collect_list(item)).alias("_c"))
    pooled = F.filter("_c", lambda i: i["_pooled"])
    return per.select(*PAGE, "tok_id", F.coalesce(_chosen(pooled), _chosen(F.col("_c"))).alias("_l")).select(*PAGE, "tok_id", "_l.cluster", "_l.weak")


def code_cluster_pairs(codes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Codes (price_position) with the clusters above or below them within a tile."""
    dy = F.col("cl_cy") - F.col("cy")
    toward = F.when(F.col("price_position") == "below", dy).otherwise(-dy)
    return codes.join(clusters.select(*PAGE, "cluster", "cl_cx", "cl_cy", "cl_x0", "cl_x1", "strong"), PAGE).where((toward > 0) & (toward <= R.TILE_HEIGHT))


def capacity_near(codes: DataFrame, sources: DataFrame) -> DataFrame:
    """file, page, tok_id, capacity, a_x0, a_x1: of the sources (capacity, rank, dy_min, s_*) in reach the one of least |dx| that no other code blocks."""
    dy, dx = F.col("cy") - F.col("s_cy"), F.abs(F.col("s_cx") - F.col("cx"))
    pairs = codes.select(*PAGE, "tok_id", "cx", "cy").join(sources, PAGE).where((dy >= F.col("dy_min")) & (dy <= 700) & (dx < 500)).withColumn("dx", dx)
    others = codes.select(*[F.col(c).alias(f"_{c}") for c in PAGE], F.col("tok_id").alias("_tok"), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"))
    between = (F.col("_cy") > F.least("s_cy", "cy") + 15) & (F.col("_cy") < F.greatest("s_cy", "cy") - 15) & (F.abs(F.col("_cx") - F.col("s_cx")) < 500)
    free = pairs.join(others, (F.col("file") == F.col("_file")) & (F.col("page") == F.col("_page")) & (F.col("tok_id") != F.col("_tok")) & between, "left_anti")
    best = F.min_by(F.struct("capacity", "s_x0", "s_x1"), F.struct("dx", "rank", "s_tok")).alias("b")
    return free.groupBy(*PAGE, "tok_id").agg(best).select(*PAGE, "tok_id", F.col("b.capacity").alias("capacity"), F.col("b.s_x0").alias("a_x0"), F.col("b.s_x1").alias("a_x1"))


def capacity_sources(tokens: DataFrame, chips: DataFrame) -> DataFrame:
    s = [F.col("tok_id").alias("s_tok"), *[F.col(c).alias(f"s_{c}") for c in ("cx", "cy", "x0", "x1")]]
    printed = tokens.withColumn("capacity", capacity(F.col("text"))).where("capacity is not null").select(*PAGE, *s, "capacity", F.lit(0).alias("rank"), F.lit(-30.0).alias("dy_min"))
    stacked = tokens.join(chips, [*PAGE, "tok_id"]).select(*PAGE, *s, F.col("chip").alias("capacity"), F.lit(1).alias("rank"), F.lit(-320.0).alias("dy_min"))
    return printed.unionByName(stacked)


def shared_with(rows: DataFrame) -> DataFrame:
    """rows (tok_id, cluster, matched_code) with _shared: the code before it, in reading order, that is linked to the same cluster. Only matched codes share."""
    matched = F.col("matched_code").isNotNull()
    users = Window.partitionBy(*PAGE, "cluster", matched).orderBy("tok_id")
    return rows.withColumn("_shared", F.when(matched & F.col("cluster").isNotNull(), F.lag("matched_code").over(users)))


def extract_rows(tokens: DataFrame, catalog: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """A row for each code of a page, matched or not.

    positions: file, price_position; above the code where it is missing.
    Columns: file, page, tok_id, model, matched_code, brand, category, sub,
    capacity, rrp, promo, badge, confidence, flags, member, cluster_dy,
    out_of_category. What several joins read (tokens, catalog, chips, clusters,
    codes) is written on the way, so that it is planned and computed
    once and survives lost executors.
    """
    tokens, catalog = keep(placed(tokens), "page-tokens"), keep(catalog, "page-catalog")
    chips = keep(capacity_chips(tokens), "page-chips")
    clusters = keep(cluster_table(price_clusters(price_tokens(tokens, chips))), "page-clusters")
    codes = keep(model_codes(tokens, catalog), "page-codes")
    on_page = codes.groupBy(*PAGE).agg((F.count("matched_code") == 0).alias("out_of_category"))
    codes = codes.join(on_page, PAGE)
    if positions is not None:
        codes = codes.join(positions.select("file", "price_position"), "file", "left").withColumn("price_position", F.coalesce("price_position", F.lit("above")))
    else:
        codes = codes.withColumn("price_position", F.lit("above"))
    codes = codes.join(capacity_near(codes, capacity_sources(tokens, chips)), [*PAGE, "tok_id"], "left")
    codes = codes.withColumns({"t_x0": F.least("x0", F.coalesce("a_x0", "x0")), "t_x1": F.greatest("x1", F.coalesce("a_x1", "x1")), "capacity": F.coalesce("capacity", F.lit(""))})
    codes = keep(codes, "page-placed-codes")
    keys = [*PAGE, "tok_id"]
    linked = keep(link(code_cluster_pairs(codes, clusters), column_pools(codes, clusters)), "page-links")
    values = keep(resolve_prices(cluster_values(clusters, tokens.where(F.col("text").rlike(R.MEMBER)))), "page-prices")
    rows = codes.join(linked, keys, "left").join(values.select(*PAGE, "cluster", "cl_cy", "notes", "resolution"), [*PAGE, "cluster"], "left")
    rows = code_metadata(rows, catalog)
    matched = F.col("matched_code").isNotNull()
    rows = shared_with(rows)
    linked = F.col("cluster").isNotNull()
    none = F.array().cast("array<struct<code:string,detail:string>>")
    reason = F.when(F.col("flag") == "", "no candidates").otherwise(F.col("flag"))
    weak = (F.coalesce("weak", F.lit(False)), flag("weak_cluster", "its only price is one plain number"))
    notes = F.coalesce("notes", none)
    why = F.col("resolution.why")
    for_matched = F.concat(
        flags(
            (F.col("flag") != "", flag("match", F.col("flag"))),
            weak,
            (~linked, flag("no_cluster", "no prices in reach of the code")),
            (F.col("_shared").isNotNull(), flag("shared_cluster", "takes its prices from the same place as ", F.col("_shared"))),
        ),
        notes,
        F.array_compact(F.array(why)),
    )
    for_unmatched = F.concat(
        flags(
            (F.col("out_of_category"), flag("out_of_category", "no code of this page is in the catalog")),
            (F.lit(True), flag("unmatched", "not in the catalog: ", reason)),
            (F.col("best_guess").isNotNull(), flag("nearest", "most alike: ", F.col("best_guess"))),
            weak,
        ),
        notes,
    )
    confidence = F.when(linked, F.least("confidence", "resolution.confidence")).otherwise(F.col("confidence") * 0.5)
    member = F.regexp_replace(F.col("resolution.member").cast("string"), r"\.0$", "")
    return rows.select(
        *keys,
        F.col("norm").alias("model"),
        "matched_code",
        "brand",
        "category",
        "sub",
        "capacity",
        F.col("resolution.rrp").alias("rrp"),
        F.col("resolution.promo").alias("promo"),
        F.col("resolution.pct").alias("badge"),
        F.when(matched, F.round(confidence, 2)).otherwise(0.0).alias("confidence"),
        F.when(matched, for_matched).otherwise(for_unmatched).alias("flags"),
        F.coalesce(F.concat(F.lit("Member price "), member), F.lit("")).alias("member"),
        F.when(matched, F.col("cl_cy") - F.col("cy")).alias("cluster_dy"),
        "out_of_category",
    )
