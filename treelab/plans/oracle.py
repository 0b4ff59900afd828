"""SQL counterparts of the registered queries, for any engine with md5, window functions and ASOF joins."""

from __future__ import annotations

from treelab.functions.hashing import POISSON_CDF
from treelab.plans.fixtures import MIXED_COLS, SCALE_COLS, SCORE_WEIGHTS, VECTOR_SIZE, WIDE_COLS
from treelab.plans.queries import (BOOST, FOREST_BINS, FOREST_DEPTH, FOREST_TREES, GBT_ROUNDS, PERM_REPEATS, REG_BASE, REG_SETTINGS,
                                   SWEEP_DEPTHS, TREE_BINS, TREE_DEPTH)


def u(key: str, at: int = 1) -> str:
    return f"(('0x' || substr(md5({key}), {at}, 8))::BIGINT / 4294967296.0)"


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({s})" for n, s in ctes) + "\n" + final


def flip(clean: str, uniform: str) -> str:
    return f"CASE WHEN {uniform} < 0.05 THEN 1 - ({clean})::INT ELSE ({clean})::INT END"


# --- feature tables -----------------------------------------------------------------------------------------------

_f = {i: f"embedding[{i + 1}]::DOUBLE" for i in range(VECTOR_SIZE)}
WIDE = ("wide", f"SELECT vec_id AS row_id, {', '.join(f'{e} AS f{i}' for i, e in _f.items())}, "
        + flip(f"({_f[14]} > 0 AND {_f[28]} > -0.1) OR {_f[3]} > 0.15", u("vec_id || ':flip'")) + " AS label FROM embeddings")
_clean = "o_totalprice > 300000 OR (c_acctbal < 2000 AND o_orderpriority IN ('1-URGENT', '2-HIGH'))"
MIXED_RAW = ("mixed_raw", f"""SELECT o_orderkey AS row_id, o_totalprice,
    CASE WHEN NOT {u("o_orderkey || ':null'")} < 0.02 THEN c_acctbal END AS c_acctbal, c_nationkey, o_orderpriority,
    c_mktsegment, o_orderstatus, {flip(_clean, u("o_orderkey || ':flip'"))} AS label
    FROM orders JOIN customer ON o_custkey = c_custkey""")
PRESENT = ("present", f"SELECT * FROM mixed_raw WHERE {' AND '.join(c + ' IS NOT NULL' for c in MIXED_COLS)}")


def rank_of(col: str) -> str:
    return f"(dense_rank() OVER (ORDER BY {col}) - 1)::INT"


MIXED = ("mixed", f"""SELECT row_id, o_totalprice, c_acctbal, c_nationkey::DOUBLE AS c_nationkey,
    {', '.join(f'{rank_of(c)}::DOUBLE AS {c}' for c in MIXED_COLS[3:])}, label FROM present""")
_rid = "l_orderkey || ':' || l_partkey || ':' || l_suppkey || ':' || l_linenumber || ':' || round(l_extendedprice * 100)::BIGINT"
SCALE = ("scale", f"""SELECT row_id, {', '.join(SCALE_COLS)}, {flip('l_quantity > 30 AND l_discount < 0.06::DOUBLE', u('row_id'))} AS label
    FROM (SELECT *, {_rid} AS row_id FROM lineitem)""")


def split(src: str, out: str, frac: float = 0.2, seed: int = 42, col: str = "split", names=("train", "test")) -> list[tuple[str, str]]:
    return [
        (f"{out}_q", f"""SELECT label, floor(e)::BIGINT + (row_number() OVER (ORDER BY e - floor(e) DESC, label::VARCHAR)
            <= wanted - sum(floor(e)) OVER ())::INT AS quota
          FROM (SELECT label, w AS wanted, w * n / total AS e FROM (
            SELECT label, count(*) AS n, sum(count(*)) OVER () AS total, ceil({frac}::DOUBLE * sum(count(*)) OVER ()) AS w
            FROM {src} GROUP BY label))"""),
        (out, f"""SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY s.label ORDER BY md5(row_id || ':{seed}')) <= quota
            THEN '{names[1]}' ELSE '{names[0]}' END AS {col} FROM {src} s JOIN {out}_q USING (label)""")]


def folds(src: str, k: int, seed: int = 42) -> str:
    return f"SELECT *, (ntile({k}) OVER (PARTITION BY label ORDER BY md5(row_id || ':{seed}')) - 1)::INT AS fold FROM {src}"


SCALE_SPLIT = [SCALE, *split("scale", "data")]
MIXED_SPLIT = [MIXED_RAW, PRESENT, MIXED, *split("mixed", "data")]
SCORED = [MIXED_RAW, ("known", "SELECT * FROM mixed_raw WHERE c_acctbal IS NOT NULL"), *split("known", "known_split"),
          ("scored", " UNION ALL ".join(
              f"""SELECT '{m}' AS model, row_id, split, label, floor(({a}::DOUBLE * (least(o_totalprice, 500000.0::DOUBLE) / 500000.0::DOUBLE)
              + {b}::DOUBLE * (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT::DOUBLE + {c}::DOUBLE * {u("row_id || ':score'")}) * 100)
              / 100.0::DOUBLE AS p1 FROM known_split""" for m, (a, b, c) in SCORE_WEIGHTS.items())),
          ("s", "SELECT *, (p1 >= 0.5)::INT AS prediction FROM scored")]
SINE = [("sine", f"""SELECT row_id, x, sin(x) + 0.1::DOUBLE * (sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {u("row_id || ':42:a'")}))
    * cos({2 * 3.141592653589793!r}::DOUBLE * {u("row_id || ':42:b'")})) AS y
    FROM (SELECT o_orderkey AS row_id, 10.0::DOUBLE * {u("o_orderkey || ':x'")} AS x FROM orders)""")]


def long_table(src: str, cols: list[str], keep: str) -> str:
    return " UNION ALL ".join(f"SELECT {keep}, {i} AS f, '{c}' AS feature, {c}::DOUBLE AS v FROM {src}" for i, c in enumerate(cols))


# --- trees --------------------------------------------------------------------------------------------------------

def binning(src: str, cols: list[str], max_bins: int, fit: str = "true") -> list[tuple[str, str]]:
    """Cut points (midpoints, or equal widths above ``max_bins`` values) and the bin of every (row, feature)."""
    return [
        ("long", long_table(src, cols, "row_id, " + fit + " AS fit")),
        ("dist", "SELECT f, count(DISTINCT v) AS nd, min(v) AS lo, max(v) AS hi FROM long WHERE fit GROUP BY f"),
        ("edges", f"""SELECT f, e, row_number() OVER (PARTITION BY f ORDER BY e) AS k FROM (
            SELECT f, (v + nv) / 2.0::DOUBLE AS e FROM (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nv
              FROM (SELECT DISTINCT f, v FROM long WHERE fit)) JOIN dist USING (f) WHERE nd <= {max_bins} AND nv IS NOT NULL
            UNION ALL SELECT f, lo + (hi - lo) * i / {max_bins} FROM dist, range(1, {max_bins}) t(i) WHERE nd > {max_bins})"""),
        ("binned", "SELECT l.row_id, l.f, coalesce(e.k, 0) AS bin FROM long l ASOF LEFT JOIN edges e ON l.f = e.f AND l.v > e.e"),
        ("names", " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature" for i, c in enumerate(cols)))]


def gini_gain() -> str:
    def purity(x):
        return f"({x}s0 * {x}s0 + {x}s1 * {x}s1) / ({x}s0 + {x}s1)"
    return (f"CASE WHEN l_s0 + l_s1 >= 1 AND r_s0 + r_s1 >= 1 THEN ({purity('l_')} + {purity('r_')} - {purity('t_')}) / (t_s0 + t_s1) END")


def newton_gain(lam: float, alpha: float, gamma: float, min_child: float = 1.0) -> str:
    def score(x):
        return f"pow(greatest(abs({x}g) - {alpha}::DOUBLE, 0), 2) / ({x}h + {lam}::DOUBLE)"
    return (f"CASE WHEN l_h >= {min_child} AND r_h >= {min_child} THEN 0.5::DOUBLE * ({score('l_')} + {score('r_')} - {score('t_')})"
            f" - {gamma}::DOUBLE END")


GINI_OPEN = "t_s0 > 0 AND t_s1 > 0 AND t_s0 + t_s1 >= 2"


def levels(p: str, start: str, stats: list[str], gain: str, open_: str, depth: int, feats: str | None = None) -> list[tuple[str, str]]:
    """Grow from ``start`` (tree, row_id, stats, n): split tables, positions per level, and ``<p>nodes``."""
    every = [*stats, "n"]

    def each(text):
        return ", ".join(text.replace("#", s) for s in every)

    out = [(f"{p}cur0", f"SELECT *, 0 AS node FROM ({start})")]
    for lv in range(depth):
        pick = ""
        if feats:
            out.append((f"{p}feats{lv}", feats.replace("{nodes}", f"(SELECT DISTINCT tree, node FROM {p}cur{lv} WHERE node >= {2 ** lv - 1})")))
            pick = f"JOIN {p}feats{lv} USING (tree, node, f)"
        out += [
            (f"{p}hist{lv}", f"""SELECT tree, node, f, bin, {each('sum(#) AS #')} FROM {p}cur{lv} JOIN binned USING (row_id) {pick}
                WHERE node >= {2 ** lv - 1} GROUP BY tree, node, f, bin"""),
            (f"{p}best{lv}", f"""SELECT *, round({gain}, 10) AS gain FROM (SELECT *, {each('t_# - l_# AS r_#')} FROM (
                SELECT tree, node, f, bin, {each('sum(#) OVER (PARTITION BY tree, node, f ORDER BY bin) AS l_#')},
                {each('sum(#) OVER (PARTITION BY tree, node, f) AS t_#')} FROM {p}hist{lv})) WHERE l_n > 0 AND l_n < t_n
                QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY round({gain}, 10) DESC NULLS LAST, f, bin) = 1"""),
            (f"{p}split{lv}", f"SELECT * FROM {p}best{lv} WHERE gain > 0 AND {open_}"),
            (f"{p}cur{lv + 1}", f"""SELECT c.tree, c.row_id, {', '.join('c.' + s for s in every)},
                CASE WHEN s.f IS NULL THEN c.node WHEN b.bin <= s.bin THEN 2 * c.node + 1 ELSE 2 * c.node + 2 END AS node
                FROM {p}cur{lv} c LEFT JOIN {p}split{lv} s USING (tree, node) LEFT JOIN binned b ON b.row_id = c.row_id AND b.f = s.f""")]
    parts = [f"SELECT tree, node, 0 AS depth, {each('t_# AS #')} FROM {p}best0"]
    for lv in range(depth):
        parts += [f"SELECT tree, 2 * node + {1 if side == 'l' else 2}, {lv + 1}, {each(side + '_#')} FROM {p}split{lv}" for side in "lr"]
    splits = " UNION ALL ".join(f"SELECT tree, node, f, bin, gain FROM {p}split{lv}" for lv in range(depth))
    out.append((f"{p}nodes", f"""SELECT n.*, s.f, s.bin, s.gain, e.e AS threshold, m.feature FROM ({' UNION ALL '.join(parts)}) n
        LEFT JOIN ({splits}) s USING (tree, node) LEFT JOIN edges e ON e.f = s.f AND e.k = s.bin + 1 LEFT JOIN names m ON m.f = s.f"""))
    return out


ONE_TREE = "SELECT 0 AS tree, row_id, tr * (1 - label) AS s0, tr * label AS s1, tr AS n FROM (SELECT *, (split = 'train')::INT AS tr FROM data)"


def scale_tree(depth: int) -> list[tuple[str, str]]:
    return [*SCALE_SPLIT, *binning("data", SCALE_COLS, TREE_BINS, "split = 'train'"),
            *levels("", ONE_TREE, ["s0", "s1"], gini_gain(), GINI_OPEN, depth)]



def full_tree(src: str, cols: list[str], fit: str = "true", depth: int | None = None, cut: str = "(b.v + b.nv) / 2.0::DOUBLE") -> list[tuple[str, str]]:
    """A fully grown tree by recursion: ``grown`` holds every row at every node it passes, ``full_splits`` the split of each inner node."""
    def best(rows: str) -> str:
        return f"""(SELECT path, f, v, nv, gain, t_n, t_s1 FROM (
            SELECT *, round(((l_s0 * l_s0 + l_s1 * l_s1) / l_n + (r_s0 * r_s0 + r_s1 * r_s1) / r_n - (t_s0 * t_s0 + t_s1 * t_s1) / t_n) / t_n, 10) AS gain FROM (
              SELECT *, t_n - l_n AS r_n, t_s1 - l_s1 AS r_s1, l_n - l_s1 AS l_s0, t_n - l_n - t_s1 + l_s1 AS r_s0, t_n - t_s1 AS t_s0 FROM (
                SELECT path, f, v, lead(v) OVER w AS nv, sum(n) OVER w AS l_n, sum(s1) OVER w AS l_s1,
                  sum(n) OVER (PARTITION BY path, f) AS t_n, sum(s1) OVER (PARTITION BY path, f) AS t_s1
                FROM (SELECT path, f, v, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS s1 FROM (
                  SELECT path, label, unnest([{', '.join(str(i) for i in range(len(cols)))}]) AS f, unnest([{', '.join(f'{c}::DOUBLE' for c in cols)}]) AS v FROM {rows} WHERE fit)
                  GROUP BY path, f, v) WINDOW w AS (PARTITION BY path, f ORDER BY v)))
              WHERE nv IS NOT NULL AND t_s0 > 0 AND t_s1 > 0)
            WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, v) = 1)"""
    features = ", ".join(f"g.{c}" for c in cols)
    value = "CASE b.f " + " ".join(f"WHEN {i} THEN g.{c}::DOUBLE" for i, c in enumerate(cols)) + " END"
    return [("grown", f"""SELECT '' AS path, {fit} AS fit, label, {', '.join(cols)} FROM {src} UNION ALL
          SELECT g.path || CASE WHEN {value} <= {cut} THEN '0' ELSE '1' END, g.fit, g.label, {features}
          FROM grown g JOIN {best('grown')} b USING (path){'' if depth is None else f' WHERE length(path) < {depth}'}"""),
            ("full_splits", f"SELECT *, (v + nv) / 2.0::DOUBLE AS threshold FROM {best('grown')}")]


def recursive(ctes: list[tuple[str, str]], final: str, name: str) -> str:
    """As ``with_`` with one recursive table."""
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS {'' if n == name else 'MATERIALIZED '}({s})" for n, s in ctes) + "\n" + final


FULL_TREE = [*MIXED_SPLIT, *full_tree("data", MIXED_COLS, "split = 'train'")]
FULL_TREE_SQL = recursive(FULL_TREE, f"""SELECT path, length(path)::INT AS depth, c.feature, round(threshold, 8) AS threshold, s.f IS NULL AS is_leaf, n AS n_samples,
    (n - s1)::BIGINT AS count_0, s1::BIGINT AS count_1, round(1 - pow((n - s1) / n::DOUBLE, 2) - pow(s1 / n::DOUBLE, 2), 6) AS impurity,
    round(gain, 6) AS gain, (s1 > n - s1)::INT AS prediction
    FROM (SELECT path, count(*) AS n, sum(label) AS s1 FROM grown WHERE fit GROUP BY path) LEFT JOIN full_splits s USING (path)
    LEFT JOIN (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(MIXED_COLS))}) c(f, feature) ON c.f = s.f""", "grown")
SWEEP_SQL = recursive([*SCALE_SPLIT, *binning("data", SCALE_COLS, TREE_BINS, "split = 'train'"),
    ("positions", f"""SELECT d.split, d.label, {', '.join(f'max(CASE WHEN f = {i} THEN bin END) AS b{i}' for i in range(len(SCALE_COLS)))}
        FROM data d JOIN binned USING (row_id) GROUP BY row_id, d.split, d.label"""),
    *full_tree("positions", [f"b{i}" for i in range(len(SCALE_COLS))], "split = 'train'", SWEEP_DEPTHS[-1], "b.v"),
    ("verdicts", """SELECT path, length(path) AS depth, (2 * sum(label) FILTER (fit) > count(*) FILTER (fit))::INT AS prediction,
        path NOT IN (SELECT path FROM full_splits) AS is_leaf FROM grown GROUP BY path"""),
    ("counted", """SELECT v.depth, v.is_leaf, g.fit, count(*) AS n, sum((g.label = v.prediction)::INT) AS hits
        FROM grown g JOIN verdicts v USING (path) GROUP BY ALL""")],
    f"""SELECT d::INT AS depth, round(sum(hits) FILTER (fit) / sum(n) FILTER (fit), 6) AS train_acc, round(sum(hits) FILTER (NOT fit) / sum(n) FILTER (NOT fit), 6) AS test_acc
    FROM range(1, {SWEEP_DEPTHS[-1] + 1}) r(d) JOIN counted c ON c.depth = d OR (c.is_leaf AND c.depth < d) GROUP BY d""", "grown")
FULL_TREE_SUMMARY_SQL = recursive([*FULL_TREE, ("leaves", """SELECT path, (2 * sum(label) > count(*))::INT AS prediction FROM grown
    WHERE fit AND path NOT IN (SELECT path FROM full_splits) GROUP BY path""")],
    """SELECT round(avg(hit) FILTER (fit), 6) AS train_acc, round(avg(hit) FILTER (NOT fit), 6) AS test_acc,
    (SELECT max(length(path))::INT FROM grown WHERE fit) AS depth, (SELECT count(*) FROM leaves) AS leaves
    FROM (SELECT g.fit, (g.label = l.prediction)::INT AS hit FROM grown g JOIN leaves l USING (path))""", "grown")


def weight_case(t: str, row: str = "row_id") -> str:
    uni = f"(('0x' || substr(md5({row} || ':42:' || ({t} // 4)), 1 + 8 * ({t} % 4), 8))::BIGINT / 4294967296.0)"
    return "(" + " + ".join(f"({uni} >= {c!r}::DOUBLE)::INT" for c in POISSON_CDF) + ")"


SQRT_FEATS = ("SELECT tree, node, f FROM {nodes}, names QUALIFY row_number() OVER (PARTITION BY tree, node "
              "ORDER BY md5('42:split:' || tree || ':' || node || ':' || feature), f) <= 2")
FOREST = [*MIXED_SPLIT, *binning("data", MIXED_COLS, FOREST_BINS, "split = 'train'"),
          ("bag", f"SELECT t AS tree, row_id, label, split, {weight_case('t')} AS w FROM data, range({FOREST_TREES}) r(t)"),
          *levels("", """SELECT tree, row_id, w * (1 - label) * (split = 'train')::INT AS s0, w * label * (split = 'train')::INT AS s1,
                (w > 0 AND split = 'train')::INT AS n FROM bag""", ["s0", "s1"], gini_gain(), GINI_OPEN, FOREST_DEPTH, SQRT_FEATS),
          ("votes", f"""SELECT b.tree, b.row_id, b.label, b.split, b.w, n.s1 / (n.s0 + n.s1) AS p
                FROM bag b JOIN cur{FOREST_DEPTH} c USING (tree, row_id) JOIN nodes n ON n.tree = c.tree AND n.node = c.node""")]
OOB = ("oob", """SELECT tree + 1 AS n_trees, label, sum((w = 0)::INT) OVER o AS votes, sum(CASE WHEN w = 0 THEN p ELSE 0 END) OVER o AS ones
    FROM votes WHERE split = 'train' WINDOW o AS (PARTITION BY row_id ORDER BY tree)""")
OOB_CURVE = """SELECT n_trees::INT AS n_trees, count(*) FILTER (votes > 0) AS n_rows, round(avg(hit), 6) AS oob_score, round(1 - avg(hit), 6) AS oob_error
    FROM (SELECT n_trees, votes, CASE WHEN votes > 0 THEN ((round(ones - votes / 2.0::DOUBLE, 9) > 0)::INT = label)::INT END AS hit FROM oob)
    GROUP BY n_trees"""


def importance(nodes: str, n_trees: int, cols: list[str]) -> list[tuple[str, str]]:
    return [(f"{nodes}_share", f"""SELECT tree, feature, s / sum(s) OVER (PARTITION BY tree) AS s FROM (
                SELECT n.tree, n.feature, sum(n.gain * (n.s0 + n.s1) / (r.s0 + r.s1)) AS s FROM {nodes} n
                JOIN {nodes} r ON r.tree = n.tree AND r.node = 0 WHERE n.f IS NOT NULL GROUP BY n.tree, n.feature)"""),
            (f"{nodes}_imp", f"""SELECT feature, round(coalesce(sum(s) / {n_trees}.0::DOUBLE, 0), 6) AS importance
                FROM names LEFT JOIN {nodes}_share USING (feature) GROUP BY feature""")]


def boost_ctes(b=BOOST, p: str = "") -> list[tuple[str, str]]:
    """Rounds of one boosted model; ``p`` prefixes its tables (margins ``<p>m<t>``, nodes ``<p>bnodes``)."""
    keep = int(b.colsample_bytree * len(SCALE_COLS))
    shrunk = f"sign(g) * greatest(abs(g) - {b.reg_alpha}::DOUBLE, 0)"
    out = [(f"{p}m0", "SELECT row_id, label, split, 0.0::DOUBLE AS margin FROM data")]
    for t in range(b.n_rounds):
        sample = "(split = 'train')::INT"
        if b.subsample < 1:
            sample = f"(split = 'train' AND {u(f"""row_id || ':42:row:{t}' """)} < {b.subsample}::DOUBLE)::INT"
        start = (f"SELECT {t} AS tree, row_id, s * (p - label) AS g, s * p * (1 - p) AS h, s AS n FROM ("
                 f"SELECT *, {sample} AS s, 1 / (1 + exp(-margin)) AS p FROM {p}m{t})")
        feats = None if keep >= len(SCALE_COLS) else (
            "SELECT tree, node, f FROM {nodes}, names QUALIFY row_number() OVER (PARTITION BY tree, node "
            f"ORDER BY md5('42:{t}:' || feature), f) <= {keep}")
        q = f"{p}b{t}_"
        out += levels(q, start, ["g", "h"], newton_gain(b.reg_lambda, b.reg_alpha, b.gamma), "t_n >= 2", b.max_depth, feats)
        out += [(f"{q}leaf", f"SELECT *, {b.learning_rate}::DOUBLE * (-({shrunk}) / (h + {b.reg_lambda}::DOUBLE)) AS value FROM {q}nodes"),
                (f"{p}m{t + 1}", f"""SELECT m.row_id, m.label, m.split, m.margin + l.value AS margin FROM {p}m{t} m
                    JOIN {q}cur{b.max_depth} c USING (row_id) JOIN {q}leaf l ON l.node = c.node""")]
    out.append((f"{p}bnodes", " UNION ALL ".join(f"SELECT * FROM {p}b{t}_leaf" for t in range(b.n_rounds))))
    return out


VARIANCE_GAIN = "CASE WHEN l_n >= 1 AND r_n >= 1 THEN (l_s * l_s / l_n + r_s * r_s / r_n - t_s * t_s / t_n) / t_n END"


def gradient_ctes(src: str, rounds: int, rate: float, depth: int, sample: str, target: str, weight: str, start: str, feats: str | None = None) -> list[tuple[str, str]]:
    """Rounds of residual trees: ``target`` and ``weight`` are the residual and the divisor of a leaf's sum, from ``margin`` and ``p``."""
    out = [("m0", f"SELECT *, ({start})::DOUBLE AS margin FROM {src}")]
    for t in range(rounds):
        q = f"g{t}_"
        rows = (f"SELECT {t} AS tree, row_id, w * ({target}) AS s, w * ({weight}) AS q, w AS n FROM (SELECT *, {sample.replace('{t}', str(t))} AS w, "
                f"1 / (1 + exp(-margin)) AS p FROM m{t})")
        out += levels(q, rows, ["s", "q"], VARIANCE_GAIN, "t_n >= 2", depth, feats and feats.replace("{t}", str(t)))
        out += [(f"{q}leaf", f"SELECT *, {rate}::DOUBLE * s / q AS value FROM {q}nodes"),
                (f"m{t + 1}", f"SELECT m.* REPLACE (m.margin + l.value AS margin) FROM m{t} m JOIN {q}cur{depth} c USING (row_id) JOIN {q}leaf l ON l.node = c.node")]
    return out


GBT = [*SCALE_SPLIT, *binning("data", SCALE_COLS, TREE_BINS, "split = 'train'"),
       *gradient_ctes("data", GBT_ROUNDS, 0.1, 3, f"""(split = 'train' AND {u("row_id || ':42:row:{t}'")} < 0.8::DOUBLE)::INT""", "label - p", "p * (1 - p)",
                      "SELECT ln(a / (1 - a)) FROM (SELECT avg(label) AS a FROM data WHERE split = 'train')",
                      "SELECT tree, node, f FROM {nodes}, names QUALIFY row_number() OVER (PARTITION BY tree, node "
                      "ORDER BY md5('42:split:{t}:' || node || ':' || feature), f) <= 2")]
GBT_SQL = with_(GBT, " UNION ALL ".join(
    f"""SELECT {t}::INT AS tree_id, node::INT AS node_id, feature, round(threshold, 8) AS threshold, n::BIGINT AS n_samples, round(n::DOUBLE, 6) AS cover,
        round(value, 6) AS value, round(gain, 6) AS gain FROM g{t}_leaf""" for t in range(GBT_ROUNDS)))
def _bin_split(rows: str) -> str:
    """One level of a residual tree over sums by bin (node, bin, n, s)."""
    return f"""(SELECT * EXCLUDE (l_n, l_s, t_n, t_s, gain, cut, top) REPLACE (CASE WHEN top > 0 THEN 2 * node + CASE WHEN bin <= cut THEN 1 ELSE 2 END ELSE node END AS node)
        FROM (SELECT *, first_value(bin) OVER (PARTITION BY node ORDER BY gain DESC NULLS LAST, bin) AS cut, max(gain) OVER (PARTITION BY node) AS top
          FROM (SELECT *, CASE WHEN l_n < t_n THEN round((l_s * l_s / l_n + (t_s - l_s) * (t_s - l_s) / (t_n - l_n) - t_s * t_s / t_n) / t_n, 10) END AS gain
            FROM (SELECT *, sum(n) OVER w AS l_n, sum(s) OVER w AS l_s, sum(n) OVER (PARTITION BY node) AS t_n, sum(s) OVER (PARTITION BY node) AS t_s
              FROM {rows} WINDOW w AS (PARTITION BY node ORDER BY bin)))))"""


_round = _bin_split(_bin_split("(SELECT *, 0 AS node, sy - n * margin AS s FROM fit WHERE round < 5)"))
RESIDUAL_SQL = recursive([*SINE, *binning("sine", ["x"], 32),
                          ("sums", "SELECT bin, count(*)::DOUBLE AS n, sum(y) AS sy, sum(y * y) AS sq FROM sine JOIN binned USING (row_id) GROUP BY bin"),
                          ("fit", f"""SELECT 0 AS round, bin, n, sy, sq, (SELECT avg(y) FROM sine) AS margin FROM sums UNION ALL
                            SELECT round + 1, bin, n, sy, sq, margin + 0.5::DOUBLE * sum(s) OVER (PARTITION BY node) / sum(n) OVER (PARTITION BY node) FROM {_round}""")],
                         "SELECT round::INT AS round, round(sum(sq - 2 * margin * sy + n * margin * margin) / sum(n), 6) AS mse FROM fit GROUP BY round", "fit")
BOOST_INPUT = [*SCALE_SPLIT, *binning("data", SCALE_COLS, TREE_BINS, "split = 'train'")]
BOOSTED = [*BOOST_INPUT, *boost_ctes()]
def _regularised_round() -> str:
    """One round of all models over cells (rows with equal bins, label and split, n of them): the next margins and the leaves so far."""
    every, places = ("g", "h", "n"), ", ".join(f"b{i}" for i in range(len(SCALE_COLS)))
    score = lambda x: f"pow(greatest(abs({x}g) - alpha, 0), 2) / ({x}h + penalty)"
    each = lambda text: ", ".join(text.replace("#", c) for c in every)
    gain = f"""round(CASE WHEN l_h >= {REG_BASE.min_child_weight}::DOUBLE AND r_h >= {REG_BASE.min_child_weight}::DOUBLE
        THEN {REG_BASE.gain_scale}::DOUBLE * ({score('l_')} + {score('r_')} - {score('t_')}) - gamma END, 10)"""
    out = [("at0", f"""SELECT m, cell, margin, leaves, {places}, w * (p - label) AS g, w * p * (1 - p) AS h, w AS n, 0 AS node FROM (
        SELECT *, CASE WHEN split = 'train' THEN n ELSE 0 END AS w, 1 / (1 + exp(-margin)) AS p FROM fit JOIN cells USING (cell) WHERE round < {REG_BASE.n_rounds})""")]
    for lv in range(REG_BASE.max_depth):
        out += [(f"split{lv}", f"""SELECT m, node, f, bin FROM (SELECT *, {gain} AS gain FROM (SELECT *, {each('t_# - l_# AS r_#')} FROM (
                SELECT m, node, f, bin, {each('sum(#) OVER (PARTITION BY m, node, f ORDER BY bin) AS l_#')}, {each('sum(#) OVER (PARTITION BY m, node, f) AS t_#')}
                FROM (SELECT m, node, f, bin, {each('sum(#) AS #')} FROM (SELECT m, node, g, h, n, unnest([{', '.join(map(str, range(len(SCALE_COLS))))}]) AS f,
                    unnest([{places}]) AS bin FROM at{lv} WHERE n > 0 AND node >= {2 ** lv - 1}) GROUP BY m, node, f, bin)) JOIN settings USING (m)) WHERE l_n > 0 AND l_n < t_n)
                WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY m, node ORDER BY gain DESC, f, bin) = 1"""),
                (f"at{lv + 1}", f"""SELECT a.* REPLACE (CASE WHEN s.f IS NULL THEN a.node WHEN [{places}][s.f + 1] <= s.bin THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node)
                FROM at{lv} a LEFT JOIN split{lv} s USING (m, node)""")]
    out.append(("leaf", f"""SELECT m, node, {REG_BASE.learning_rate}::DOUBLE * -sign(g) * greatest(abs(g) - alpha, 0) / (h + penalty) AS value, count(*) OVER (PARTITION BY m) AS found
        FROM (SELECT m, node, sum(g) AS g, sum(h) AS h FROM at{REG_BASE.max_depth} WHERE n > 0 GROUP BY m, node) JOIN settings USING (m)"""))
    return with_(out, f"SELECT m, cell, margin + value AS margin, leaves + found AS leaves FROM at{REG_BASE.max_depth} JOIN leaf USING (m, node)")


REGULARISED_SQL = recursive([
    *BOOST_INPUT,
    ("settings", " UNION ALL ".join(f"SELECT {i} AS m, '{x['label']}' AS label, {x['gamma']}::DOUBLE AS gamma, {x['lambda']}::DOUBLE AS penalty, {x['alpha']}::DOUBLE AS alpha"
                                    for i, x in enumerate(REG_SETTINGS))),
    ("cells", f"""SELECT *, row_number() OVER () AS cell FROM (SELECT COLUMNS(* EXCLUDE (row_id)), count(*) AS n FROM (
        SELECT row_id, d.split, d.label, {', '.join(f'max(CASE WHEN f = {i} THEN bin END) AS b{i}' for i in range(len(SCALE_COLS)))}
        FROM data d JOIN binned USING (row_id) GROUP BY row_id, d.split, d.label) GROUP BY ALL)"""),
    ("fit", f"""SELECT 0 AS round, m, cell, 0.0::DOUBLE AS margin, 0::BIGINT AS leaves FROM cells, settings UNION ALL
        SELECT (SELECT max(round) FROM fit) + 1, m, cell, margin, leaves FROM ({_regularised_round()})"""),
    ("scored", f"""SELECT m, max(leaves) AS leaves, {', '.join(f"sum(n * ((margin > 0)::INT = label)::INT) FILTER (split = '{x}') / sum(n) FILTER (split = '{x}') AS {x}"
                                                              for x in ('train', 'test'))} FROM fit JOIN cells USING (cell) WHERE round = {REG_BASE.n_rounds} GROUP BY m""")],
    "SELECT label, gamma, penalty AS lambda, alpha, round(train, 6) AS train_acc, round(test, 6) AS test_acc, round(train - test, 6) AS gap, leaves FROM scored JOIN settings USING (m)",
    "fit")
# trees of depth two: a path has at most the root's feature (a) and one child's feature (b)
SHAP = [*BOOSTED,
        ("leaf", """SELECT l.tree, l.value, l.depth, CASE WHEN l.depth = 2 THEN r.f ELSE q.f END AS fa, CASE WHEN l.depth = 2 THEN r.bin ELSE q.bin END AS ba,
            CASE WHEN l.depth = 2 THEN q.node = 1 ELSE l.node = 1 END AS left_a,
            CASE WHEN l.depth = 2 THEN q.h / r.h ELSE l.h / q.h END AS za, CASE WHEN l.depth = 2 THEN q.f END AS fb, q.bin AS bb,
            l.node % 2 = 1 AS left_b, l.h / q.h AS zb
            FROM bnodes l JOIN bnodes q ON q.tree = l.tree AND q.node = (l.node - 1) // 2
            LEFT JOIN bnodes r ON r.tree = l.tree AND r.node = 0 WHERE l.f IS NULL AND l.depth > 0"""),
        ("met", """SELECT d.row_id, l.*, ((a.bin <= l.ba) = l.left_a)::INT AS oa, ((b.bin <= l.bb) = l.left_b)::INT AS ob
            FROM data d CROSS JOIN leaf l JOIN binned a ON a.row_id = d.row_id AND a.f = l.fa
            LEFT JOIN binned b ON b.row_id = d.row_id AND b.f = l.fb WHERE d.split = 'test'"""),
        ("part", """SELECT row_id, fa AS f, CASE WHEN fb IS NULL THEN value * (oa - za) WHEN fb = fa THEN value * (oa * ob - za * zb)
            ELSE value * (oa - za) * (zb + ob) / 2 END AS phi FROM met
            UNION ALL SELECT row_id, fb, value * (ob - zb) * (za + oa) / 2 FROM met WHERE fb <> fa"""),
        ("shap", """SELECT l.row_id, l.feature, l.v AS value, coalesce(sum(p.phi), 0) AS phi FROM long l
            JOIN data d ON d.row_id = l.row_id AND d.split = 'test' LEFT JOIN part p ON p.row_id = l.row_id AND p.f = l.f
            GROUP BY l.row_id, l.feature, l.v""")]


def exact_split(src: str, cols: list[str], stats: dict[str, str], gain: str, node: str = "0") -> list[tuple[str, str]]:
    every = [*stats, "n"]

    def each(text):
        return ", ".join(text.replace("#", s) for s in every)

    sums = ", ".join(f"sum({e})::DOUBLE AS {s}" for s, e in stats.items())
    return [("cells", " UNION ALL ".join(f"SELECT {node} AS node, {i} AS f, '{c}' AS feature, {c}::DOUBLE AS v, {sums}, count(*) AS n FROM {src} "
                                         f"GROUP BY ALL" for i, c in enumerate(cols))),
            ("run", f"""SELECT node, f, feature, v, lead(v) OVER w AS nv, {each('sum(#) OVER w AS l_#')},
                {each('sum(#) OVER (PARTITION BY node, f) AS t_#')} FROM cells WINDOW w AS (PARTITION BY node, f ORDER BY v)"""),
            ("rated", f"SELECT *, round({gain}, 10) AS gain FROM (SELECT *, {each('t_# - l_# AS r_#')} FROM run) WHERE nv IS NOT NULL"),
            ("top", f"""SELECT node, feature, round((v + nv) / 2, 8) AS threshold, round(gain, 6) AS gain, {each('l_#::DOUBLE AS l_#')}, {each('t_#::DOUBLE AS t_#')}
                FROM rated WHERE gain IS NOT NULL QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1""")]


GINI_STATS = {"s0": "1 - label", "s1": "label"}


def report_rows(name: str, p: str, r: str, f: str, support: str, src: str, group: str = "") -> str:
    return f"SELECT model, {name} AS class_name, round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1, ({support})::BIGINT AS support FROM {src} GROUP BY model{group}"


REPORT = [("cls", """SELECT model, k, coalesce(tp / nullif(pred, 0), 0) AS p, coalesce(tp / nullif(sup, 0), 0) AS r, tp, sup FROM (
            SELECT model, k, sum((label = k AND prediction = k)::INT) AS tp, sum((prediction = k)::INT) AS pred, sum((label = k)::INT) AS sup
            FROM one, (VALUES (0), (1)) v(k) GROUP BY model, k)"""),
          ("rep", "SELECT *, coalesce(2.0::DOUBLE * p * r / nullif(p + r, 0), 0) AS f FROM cls")]
REPORT_SQL = " UNION ALL ".join([
    report_rows("CASE k WHEN 0 THEN 'negative' ELSE 'positive' END", "p", "r", "f", "sup", "rep", ", k, p, r, f, sup"),
    report_rows("'accuracy'", "sum(tp) / sum(sup)", "sum(tp) / sum(sup)", "sum(tp) / sum(sup)", "sum(sup)", "rep"),
    report_rows("'macro avg'", "avg(p)", "avg(r)", "avg(f)", "sum(sup)", "rep"),
    report_rows("'weighted avg'", "sum(p * sup) / sum(sup)", "sum(r * sup) / sum(sup)", "sum(f * sup) / sum(sup)", "sum(sup)", "rep")])
LOSS = "avg(-(CASE WHEN label = 1 THEN ln(least(greatest(p1, 0.001::DOUBLE), 0.999::DOUBLE)) ELSE ln(1 - least(greatest(p1, 0.001::DOUBLE), 0.999::DOUBLE)) END))"
ROC = [("pts", "SELECT model, p1, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY model, p1"),
       ("run", """SELECT *, sum(pos) OVER w AS cpos, sum(neg) OVER w AS cneg, sum(pos) OVER m AS tpos, sum(neg) OVER m AS tneg,
            lead(pos) OVER w AS npos, lead(neg) OVER w AS nneg, row_number() OVER w AS i
            FROM pts WINDOW w AS (PARTITION BY model ORDER BY p1 DESC), m AS (PARTITION BY model)""")]
ROC_POINTS = "SELECT model, {extra} round(cneg / tneg, 6) AS fpr, round(cpos / tpos, 6) AS tpr, round(p1, 8) AS threshold FROM run {where}"
ROC_START = "SELECT DISTINCT model, {extra} 0.0::DOUBLE, 0.0::DOUBLE, 'infinity'::DOUBLE FROM run"
DESCRIBE = """SELECT feature, count(v) AS count, round_even(avg(v), 2) AS mean, round_even(stddev_samp(v), 2) AS std, round_even(min(v), 2) AS min,
    round_even(quantile_cont(v, 0.25), 2) AS p25, round_even(quantile_cont(v, 0.5), 2) AS p50, round_even(quantile_cont(v, 0.75), 2) AS p75,
    round_even(max(v), 2) AS max FROM long GROUP BY feature"""
BOX_Q = "SELECT {k}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM src GROUP BY {k}"
METRIC_SQL = f"SELECT model || '%s' AS model, avg((label = prediction)::INT) AS accuracy, {LOSS} AS log_loss FROM s GROUP BY model"
DAILY = ("loss", "SELECT year(o_orderdate) * 12 + month(o_orderdate) AS iteration, round(avg(o_totalprice) / 1e6, 6) AS loss FROM orders GROUP BY 1")
def shuffle_keys(base: str, cols: list[str], repeats: int) -> str:
    """The bijection pos -> (a * pos + b) % n of every feature and repeat."""
    names = " UNION ALL ".join(f"SELECT '{c}' AS pf, {i} AS pi" for i, c in enumerate(cols))
    return f"""SELECT pf, pi, rep, n, list_filter(range(1 + ha % n, 1 + ha % n + 1000), lambda x: gcd(x, n) = 1)[1] AS a, hb % n AS b FROM (
        SELECT pf, pi, rep, (SELECT count(*) FROM {base}) AS n, ('0x' || substr(md5('42:' || pf || ':' || rep), 1, 8))::BIGINT AS ha,
          ('0x' || substr(md5('42:' || pf || ':' || rep), 9, 8))::BIGINT AS hb FROM ({names}), range({repeats}) r(rep))"""


def permuted_forest() -> list[tuple[str, str]]:
    out = [*FOREST, ("tests", "SELECT * FROM data WHERE split = 'test'"),
           ("base", "SELECT row_id, label, row_number() OVER (ORDER BY md5(row_id || ':42:pos')) - 1 AS pos FROM tests"),
           ("shuffle_keys", shuffle_keys("base", MIXED_COLS, PERM_REPEATS)),
           ("shuffled", "SELECT pf, pi, rep, s.row_id AS from_row, b.pos FROM base b, shuffle_keys k JOIN base s ON s.pos = (k.a * b.pos + k.b) % k.n"),
           ("pc0", f"SELECT b.row_id, b.label, s.pf, s.pi, s.rep, s.from_row, t AS tree, 0 AS node FROM base b JOIN shuffled s USING (pos), range({FOREST_TREES}) r(t)")]
    for lv in range(FOREST_DEPTH):
        out.append((f"pc{lv + 1}", f"""SELECT c.row_id, c.label, c.pf, c.pi, c.rep, c.from_row, c.tree,
            CASE WHEN s.f IS NULL THEN c.node WHEN b.bin <= s.bin THEN 2 * c.node + 1 ELSE 2 * c.node + 2 END AS node
            FROM pc{lv} c LEFT JOIN split{lv} s USING (tree, node)
            LEFT JOIN binned b ON b.f = s.f AND b.row_id = CASE WHEN s.f = c.pi THEN c.from_row ELSE c.row_id END"""))
    out.append(("pscore", f"""SELECT pf AS feature, rep, avg((pred = label)::INT) AS accuracy FROM (
        SELECT c.pf, c.rep, c.row_id, c.label, (round(avg(n.s1 / (n.s0 + n.s1)) - 0.5, 9) > 0)::INT AS pred FROM pc{FOREST_DEPTH} c
        JOIN nodes n ON n.tree = c.tree AND n.node = c.node GROUP BY c.pf, c.rep, c.row_id, c.label) GROUP BY pf, rep"""))
    return out


NODE_STATS = """coalesce(s0, 0)::DOUBLE AS count_0, coalesce(s1, 0)::DOUBLE AS count_1,
    round(1 - (s0 / (s0 + s1)) * (s0 / (s0 + s1)) - (s1 / (s0 + s1)) * (s1 / (s0 + s1)), 6) AS impurity"""


def node_report(depth: int, where: str = "true") -> str:
    """What a drawn tree shows, from the ``nodes`` table."""
    return f"""SELECT tree::INT AS tree_id, node AS node_id, depth, feature || ' <= ' || threshold AS split,
        round(1 - (s0 / (s0 + s1)) * (s0 / (s0 + s1)) - (s1 / (s0 + s1)) * (s1 / (s0 + s1)), 6) AS impurity, n::BIGINT AS n_samples,
        s0::DOUBLE AS count_0, s1::DOUBLE AS count_1, CASE WHEN s1 > s0 THEN 'positive' ELSE 'negative' END AS class_name,
        round(greatest(s0, s1) / (s0 + s1), 6) AS purity FROM nodes WHERE depth <= {depth} AND {where}"""


def paths(depth: int) -> list[tuple[str, str]]:
    """Rule and left/right turns from the root to every node."""
    out = [("path0", "SELECT 0 AS node, NULL::VARCHAR AS rule, '' AS turns")]
    for lv in range(depth):
        side = [f"""SELECT 2 * p.node + {1 + i} AS node, coalesce(rule || ' AND ', '') || n.feature || ' {op} ' || printf('%.6f', n.threshold) AS rule, turns || '{i}' AS turns
            FROM path{lv} p JOIN nodes n ON n.node = p.node AND n.f IS NOT NULL""" for i, op in enumerate(("<=", ">"))]
        out.append((f"path{lv + 1}", " UNION ALL ".join(side)))
    out.append(("paths", " UNION ALL ".join(f"SELECT * FROM path{k}" for k in range(depth + 1))))
    return out


RULES_TEXT = """SELECT 0 AS tree_id, row_number() OVER (ORDER BY pos)::INT AS line_no, line FROM (
    SELECT turns || '0' AS pos, repeat('|   ', depth) || '|--- ' || feature || ' <= ' || printf('%.2f', threshold) AS line FROM nodes JOIN paths USING (node) WHERE f IS NOT NULL
    UNION ALL SELECT turns || '1', repeat('|   ', depth) || '|--- ' || feature || ' >  ' || printf('%.2f', threshold) FROM nodes JOIN paths USING (node) WHERE f IS NOT NULL
    UNION ALL SELECT turns || '-', repeat('|   ', depth) || '|--- class: ' || (s1 > s0)::INT FROM nodes JOIN paths USING (node) WHERE f IS NULL)"""
CV_DEPTH = 3
CV = [SCALE, ("data", folds("scale", 5)), *binning("data", SCALE_COLS, TREE_BINS),
      *levels("", """SELECT k AS tree, row_id, (fold <> k)::INT * (1 - label) AS s0, (fold <> k)::INT * label AS s1, (fold <> k)::INT AS n
            FROM data, range(5) r(k)""", ["s0", "s1"], gini_gain(), GINI_OPEN, CV_DEPTH)]
ONE_MIXED = levels("one_", ONE_TREE, ["s0", "s1"], gini_gain(), GINI_OPEN, FOREST_DEPTH)
BEST_BOTH = [*FOREST, *ONE_MIXED, *importance("nodes", FOREST_TREES, MIXED_COLS), *importance("one_nodes", 1, MIXED_COLS)]

ORACLE: dict[str, str] = {
    "scan_numeric": with_([WIDE], "SELECT * FROM wide"),
    "scan_mixed": with_([MIXED_RAW], "SELECT * FROM mixed_raw"),
    "assemble_features": with_([SCALE], """SELECT label, count(*) AS n, 4::BIGINT AS width, min(l_quantity) AS min_v0, max(l_extendedprice) AS max_v1,
        max(l_discount) AS max_v2, max(l_tax) AS max_v3 FROM scale GROUP BY label"""),
    "shape_report": with_([SCALE], f"""SELECT count(*) AS n_rows, {len(SCALE_COLS)}::BIGINT AS n_features, count(DISTINCT label) AS n_classes,
        '{','.join(SCALE_COLS)}' AS feature_names FROM scale"""),
    "sine_demo": with_(SINE, "SELECT row_id, round(x, 6) AS x, round(y, 6) AS y FROM sine"),
    "sine_demo_round0": with_(SINE, "SELECT round(avg(pow(y - f0, 2)), 6) AS mse FROM sine, (SELECT avg(y) AS f0 FROM sine)"),
    "text_report": with_([*SCORED, ("mm", METRIC_SQL.replace("%s", " score"))], """SELECT model, CASE WHEN length(model) >= 12 THEN model
        ELSE rpad(model, 12, ' ') END || ' ' || printf('%8.4f', accuracy) || ' ' || printf('%8.4f', log_loss) AS line FROM mm"""),
    "label_encode_target": f"SELECT o_orderkey AS row_id, o_orderpriority, {rank_of('o_orderpriority')} AS o_orderpriority_code FROM orders",
    "target_classes": f"SELECT label_name, (row_number() OVER (ORDER BY label_name) - 1)::BIGINT AS code FROM (SELECT DISTINCT o_orderpriority AS label_name FROM orders)",
    "collapse_binary": f"""SELECT c AS o_orderpriority, (c > 0)::INT AS label, count(*) AS n
        FROM (SELECT {rank_of('o_orderpriority')} AS c FROM orders) GROUP BY c""",
    "drop_missing": with_([MIXED_RAW, PRESENT], "SELECT row_id, c_acctbal, label FROM present"),
    "encode_categoricals": with_([MIXED_RAW, PRESENT], f"SELECT row_id, {', '.join(f'{rank_of(c)} AS {c}' for c in MIXED_COLS[3:])} FROM present"),
    "coerce_numeric": """SELECT p_partkey AS row_id, try_cast(regexp_extract(p_brand, '#(.*)$', 1) AS DOUBLE) AS brand_no,
        try_cast(p_type AS DOUBLE) AS p_type FROM part""",
    "clean_flow": with_([MIXED_RAW, PRESENT, MIXED], f"SELECT row_id, {', '.join(MIXED_COLS)}, label FROM mixed"),
    "class_filter": with_([SCALE], "SELECT count(*) AS n, min(l_quantity) AS min_quantity, max(l_discount) AS max_discount FROM scale WHERE label = 1"),
    "column_subset": with_([SCALE], "SELECT l_quantity, l_discount, count(*) AS n FROM scale GROUP BY 1, 2"),
    "relabel_codes": with_([SCALE], "SELECT CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' END AS class_name, count(*) AS n FROM scale GROUP BY 1"),
    "align_target": with_([SCALE], """SELECT b.label, count(*) AS n, max(a.l_extendedprice) AS max_price FROM scale a JOIN scale b USING (row_id) GROUP BY b.label"""),
    "feature_name_join": with_([SCALE, ("long", long_table("scale", SCALE_COLS, "row_id"))],
                               "SELECT f::INT AS feature_idx, max(v) AS max_value, feature FROM long GROUP BY f, feature"),
    "class_distribution": with_([SCALE], "SELECT label, count(*) AS count FROM scale GROUP BY label ORDER BY 2 DESC, 1"),
    "class_ratio_by_split": with_(SCALE_SPLIT, "SELECT split, count(*) AS n_rows, round(avg(label), 6) AS class_ratio FROM data GROUP BY split"),
    "describe_features": with_([SCALE, ("long", long_table("scale", SCALE_COLS, "row_id"))], DESCRIBE),
    "class_histograms": with_([SCALE, ("long", long_table("scale", SCALE_COLS, "label")),
                               ("rng", "SELECT feature, label, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1, 2"),
                               ("cnt", """SELECT feature, label, least(floor((v - lo) / (hi - lo) * 30), 29)::INT AS bin, count(*) AS c
                                    FROM long JOIN rng USING (feature, label) GROUP BY 1, 2, 3""")],
                              """SELECT feature, label, b::INT AS bin, round(lo + b * ((hi - lo) / 30), 6) AS bin_left,
                                 round(lo + (b + 1) * ((hi - lo) / 30), 6) AS bin_right, coalesce(c, 0) AS count
                                 FROM rng CROSS JOIN range(30) t(b) LEFT JOIN cnt ON cnt.feature = rng.feature AND cnt.label = rng.label AND cnt.bin = b"""
                              .replace("SELECT feature, label,", "SELECT rng.feature, rng.label,")),
    "box_summary": with_([("src", "SELECT l_returnflag, floor(pow(l_extendedprice, 3) / 1e6) AS value FROM lineitem"),
                          ("q", BOX_Q.format(k="l_returnflag"))],
                         """SELECT l_returnflag, q1, median, q3, min(value) FILTER (i) AS whisker_lo, max(value) FILTER (i) AS whisker_hi,
                            count(*) FILTER (NOT i) AS n_outliers FROM (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS i
                            FROM src JOIN q USING (l_returnflag)) GROUP BY 1, 2, 3, 4"""),
    "box_outliers": with_([("src", "SELECT o_orderpriority, floor(pow(o_totalprice / 1000.0::DOUBLE, 8) / 1e9) AS value FROM orders"),
                           ("q", BOX_Q.format(k="o_orderpriority"))],
                          """SELECT o_orderpriority, count(*) AS n, min(value) AS lo, max(value) AS hi FROM src JOIN q USING (o_orderpriority)
                             WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) GROUP BY 1"""),
    "fold_mean_std": with_([*SCORED, ("fd", folds("known_split", 5)),
                            ("acc", "SELECT model, fold, avg((s.label = prediction)::INT) AS a FROM s JOIN fd USING (row_id) GROUP BY 1, 2")],
                           "SELECT model, round(avg(a), 6) AS cv_mean, round(stddev_pop(a), 6) AS cv_std FROM acc GROUP BY model"),
    "best_param_first_tie": with_([*SCORED, ("curve", """SELECT i / 20.0::DOUBLE AS cut, round(avg(((p1 >= i / 20.0::DOUBLE)::INT = label)::INT), 6) AS a
                                    FROM s, range(1, 20) t(i) WHERE model = 'price' GROUP BY i""")],
                                  "SELECT cut AS best_param, a AS best_score FROM curve ORDER BY a DESC, cut LIMIT 1"),
    "stratified_split": with_(SCALE_SPLIT, "SELECT row_id, label, split FROM data"),
    "stratified_folds": with_([SCALE, ("fd", folds("scale", 10))], "SELECT row_id, label, fold FROM fd"),
    "split_repeated_ids": """WITH sized AS (SELECT (l_quantity > 30)::INT AS label, count(*) AS n FROM lineitem GROUP BY 1),
        parts AS (SELECT label, n, 0.2::DOUBLE * 0 + ceil(0.2::DOUBLE * sum(n) OVER ()) * n / sum(n) OVER () AS e, ceil(0.2::DOUBLE * sum(n) OVER ()) AS wanted FROM sized),
        quotas AS (SELECT label, n, floor(e)::BIGINT + (row_number() OVER (ORDER BY e - floor(e) DESC, label::VARCHAR) <= wanted - sum(floor(e)) OVER ())::INT AS q FROM parts)
        SELECT label, 'test' AS split, q AS n FROM quotas UNION ALL SELECT label, 'train', n - q FROM quotas""",
    "internal_holdout": with_([*SCALE_SPLIT, ("tr", "SELECT row_id, label FROM data WHERE split = 'train'"),
                               *split("tr", "inner_", seed=43, col="part", names=("fit", "valid"))], "SELECT row_id, part FROM inner_"),
    "bootstrap_weights": with_([MIXED_RAW], f"SELECT row_id, t::INT AS tree_id, {weight_case('t')} AS weight FROM mixed_raw, range(10) r(t)"),
    "row_subsample": with_([MIXED_RAW], f"""SELECT row_id FROM mixed_raw WHERE {u("row_id || ':42:row:3'")} < 0.8::DOUBLE"""),
    "colsample_subset": f"""SELECT n_nationkey AS iteration, feature FROM nation, (VALUES {', '.join(f"('{c}')" for c in WIDE_COLS)}) v(feature)
        QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY md5('42:' || n_nationkey || ':' || feature)) <= {VECTOR_SIZE * 8 // 10}""",
    "permute_column": with_([MIXED_RAW, PRESENT, MIXED,
                             ("base", "SELECT row_id, o_totalprice AS value, row_number() OVER (ORDER BY md5(row_id || ':42:pos')) AS pos FROM mixed"),
                             ("shuf", """SELECT rep::INT AS rep, o_totalprice AS permuted, row_number() OVER (PARTITION BY rep
                                    ORDER BY md5(row_id || ':42:o_totalprice:' || rep)) AS pos FROM mixed, range(2) r(rep)""")],
                            "SELECT row_id, rep, value, permuted FROM base JOIN shuf USING (pos)"),
    "accuracy": with_(SCORED, "SELECT model, round(avg((label = prediction)::INT), 6) AS accuracy FROM s GROUP BY model"),
    "confusion_matrix": with_(SCORED, """SELECT m.model, a::INT AS label, b::INT AS prediction, count(s.row_id) AS count
        FROM (SELECT DISTINCT model FROM s) m CROSS JOIN range(2) x(a) CROSS JOIN range(2) y(b)
        LEFT JOIN s ON s.label = a AND s.prediction = b AND s.model = m.model GROUP BY 1, 2, 3"""),
    "specificity_recall": with_(SCORED, """SELECT model, tn, fp, fn, tp, round(tn / nullif(tn + fp, 0), 6) AS specificity, round(tp / nullif(tp + fn, 0), 6) AS recall
        FROM (SELECT model, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
        count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM s GROUP BY model)"""),
    "classification_report": with_([*SCORED, ("one", "SELECT * FROM s"), *REPORT], REPORT_SQL),
    "roc_points": with_([*SCORED, *ROC], ROC_POINTS.format(extra="", where="") + " UNION ALL " + ROC_START.format(extra="")),
    "roc_points_reduced": with_([*SCORED, *ROC], ROC_POINTS.format(
        extra="'curve' AS kind,", where="WHERE i = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg") + " UNION ALL "
        + ROC_START.format(extra="'curve',") + " UNION ALL SELECT DISTINCT model, 'baseline', e::DOUBLE, e::DOUBLE, NULL::DOUBLE FROM run, range(2) t(e)"),
    "auc_roc": with_([*SCORED, *ROC], """SELECT model, round(sum(neg::DOUBLE * (cpos - pos + pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS auc
        FROM run GROUP BY model"""),
    "log_loss": with_(SCORED, f"SELECT model, round({LOSS}, 6) AS log_loss FROM s GROUP BY model"),
    "overfit_gap": with_(SCORED, """SELECT model, round(a, 6) AS train_acc, round(b, 6) AS test_acc, round(a - b, 6) AS gap FROM (
        SELECT model, avg((label = prediction)::INT) FILTER (split = 'train') AS a, avg((label = prediction)::INT) FILTER (split = 'test') AS b
        FROM s GROUP BY model)"""),
    "metric_pivot": with_([*SCORED, ("mm", METRIC_SQL.replace("%s", " score"))],
                          "SELECT model, round(accuracy, 6) AS accuracy, round(log_loss, 6) AS log_loss FROM mm"),
    "running_vote_accuracy": with_([*SCORED, ("v", """SELECT label, row_number() OVER w AS n_trees, sum(p1) OVER w AS ones FROM s
        WINDOW w AS (PARTITION BY row_id ORDER BY model)""")],
        "SELECT n_trees::INT AS n_trees, round(avg(((round(ones - n_trees / 2.0::DOUBLE, 9) > 0)::INT = label)::INT), 6) AS accuracy FROM v GROUP BY 1"),
    "patience_stop": with_([DAILY, ("mk", """SELECT *, min(loss) OVER (ORDER BY iteration ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM loss"""),
                            ("bt", "SELECT *, max(CASE WHEN before IS NULL OR loss < before THEN iteration END) OVER (ORDER BY iteration) AS best_at FROM mk"),
                            ("kept", "SELECT * FROM bt WHERE iteration <= coalesce((SELECT min(iteration) FROM bt WHERE iteration - best_at >= 5), 1000000)")],
                           "SELECT max(best_at)::INT AS best_iteration, round(min(loss), 6) AS best_loss, max(iteration)::INT AS last_iteration FROM kept"),
    "window_stop": with_([DAILY, ("mk", """SELECT *, count(*) OVER w = 8 AND loss + 0.0001::DOUBLE >= max(loss) OVER w AS st FROM loss
        WINDOW w AS (ORDER BY iteration ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)""")],
        "SELECT (coalesce(min(iteration) FILTER (st), max(iteration)) + 1)::INT AS n_estimators, bool_or(st) AS stopped FROM mk"),
    "gini_root_split": with_([SCALE, *exact_split("scale", SCALE_COLS, GINI_STATS, gini_gain())], "SELECT * FROM top"),
    "gini_node_splits": with_([MIXED_RAW, PRESENT, MIXED, ("noded", "SELECT m.*, p.o_orderstatus AS flag FROM mixed m JOIN present p USING (row_id)"),
                               *exact_split("noded", MIXED_COLS, GINI_STATS, gini_gain(), "flag")], "SELECT * FROM top"),
    "second_order_root_split": with_([SCALE, *exact_split("scale", SCALE_COLS, {"g": "0.5::DOUBLE - label", "h": "0.25::DOUBLE"},
                                                          newton_gain(2.0, 0.5, 1.0))], "SELECT * FROM top"),
    "missing_routing": with_([MIXED_RAW, ("ends", "SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM mixed_raw"),
        ("cuts", "SELECT lo + (hi - lo) * k / 16 AS cut, k FROM ends, range(1, 16) t(k)"),
        ("rows_", "SELECT c_acctbal AS x, 0.5::DOUBLE - label AS g, 0.25::DOUBLE AS h FROM mixed_raw"),
        ("whole", "SELECT sum(g) AS g, sum(h) AS h, count(*) AS n FROM rows_"),
        ("sides", """SELECT cut, k, m AS missing_left, sum(g) FILTER (x <= cut OR (m AND x IS NULL)) AS gl, sum(h) FILTER (x <= cut OR (m AND x IS NULL)) AS hl,
            count(*) FILTER (x <= cut OR (m AND x IS NULL)) AS nl FROM rows_, cuts, (VALUES (true), (false)) v(m) GROUP BY cut, k, m"""),
        ("best", """SELECT s.*, w.g, w.h, w.n, 0.5::DOUBLE * (gl * gl / (hl + 1) + (w.g - gl) * (w.g - gl) / (w.h - hl + 1) - w.g * w.g / (w.h + 1)) AS gain
            FROM sides s, whole w ORDER BY gain DESC, k, missing_left DESC LIMIT 1""")],
        """SELECT 0::BIGINT AS node_id, false AS is_leaf, round(cut, 8) AS threshold, missing_left, n AS n_samples, round(h, 6) AS cover, round(-g / (h + 1), 6) AS value, round(gain, 6) AS gain FROM best
        UNION ALL SELECT 1, true, NULL, NULL, nl, round(hl, 6), round(-gl / (hl + 1), 6), NULL FROM best
        UNION ALL SELECT 2, true, NULL, NULL, n - nl, round(h - hl, 6), round(-(g - gl) / (h - hl + 1), 6), NULL FROM best"""),
    "tree_nodes": with_(scale_tree(TREE_DEPTH), f"""SELECT node AS node_id, depth, feature, round(threshold, 8) AS threshold, f IS NULL AS is_leaf,
        n::BIGINT AS n_samples, {NODE_STATS}, round(gain, 6) AS gain, (s1 > s0)::INT::DOUBLE AS prediction FROM nodes"""),
    "tree_size": with_(scale_tree(TREE_DEPTH), """SELECT tree AS tree_id, max(depth) AS depth, count(*) FILTER (f IS NULL) AS leaves,
        max(feature) FILTER (node = 0) AS root_feature FROM nodes GROUP BY tree"""),
    "tree_report": with_(scale_tree(3), node_report(2)),
    "tree_rules": with_([*scale_tree(3), *paths(3)], """SELECT 0 AS tree_id, row_number() OVER (ORDER BY turns)::INT AS leaf_no, node AS node_id, depth,
        coalesce(rule, '') AS rule, (s1 > s0)::INT::DOUBLE AS prediction, n::BIGINT AS n_samples FROM nodes JOIN paths USING (node) WHERE f IS NULL"""),
    "tree_rules_text": with_([*scale_tree(3), *paths(3)], RULES_TEXT),
    "forest_first_tree": with_(FOREST, node_report(3, "tree = 0")),
    "regularisation_table": REGULARISED_SQL,
    "depth_sweep": SWEEP_SQL,
    "full_tree": FULL_TREE_SQL,
    "gbt_nodes": GBT_SQL,
    "residual_boosting": RESIDUAL_SQL,
    "full_tree_summary": FULL_TREE_SUMMARY_SQL,
    "cv_fold_scores": with_(CV, f"""SELECT fold, round(avg(((n.s1 > n.s0)::INT = d.label)::INT), 6) AS accuracy FROM data d
        JOIN cur{CV_DEPTH} c ON c.row_id = d.row_id AND c.tree = d.fold JOIN nodes n ON n.tree = c.tree AND n.node = c.node GROUP BY fold"""),
    "forest_nodes": with_(FOREST, """SELECT tree::INT AS tree_id, node AS node_id, feature, round(threshold, 8) AS threshold, n::BIGINT AS n_samples,
        (s0 + s1)::DOUBLE AS cover, round(s1 / (s0 + s1), 6) AS value, round(gain, 6) AS gain FROM nodes"""),
    "oob_score": with_([*FOREST, OOB], f"SELECT * FROM ({OOB_CURVE}) WHERE n_trees = {FOREST_TREES}"),
    "oob_convergence": with_([*FOREST, OOB], OOB_CURVE),
    "forest_size_sweep": with_([*FOREST, ("pre", """SELECT tree + 1 AS n_trees, split, label, sum(p) OVER (PARTITION BY row_id ORDER BY tree) AS ones FROM votes"""),
                                ("hit", "SELECT n_trees, split, ((round(ones - n_trees / 2.0::DOUBLE, 9) > 0)::INT = label)::INT AS h FROM pre")],
                               """SELECT n_trees::INT AS n_trees, round(avg(h) FILTER (split = 'train'), 6) AS train_acc,
                                  round(avg(h) FILTER (split = 'test'), 6) AS test_acc FROM hit GROUP BY 1"""),
    "mdi_importance": with_([*FOREST, *importance("nodes", FOREST_TREES, MIXED_COLS)], "SELECT * FROM nodes_imp"),
    "topk_features": with_([*FOREST, *importance("nodes", FOREST_TREES, MIXED_COLS)], "SELECT * FROM nodes_imp ORDER BY importance DESC, feature LIMIT 3"),
    "permutation_scores": with_(permuted_forest(), "SELECT feature, rep::INT AS rep, round(accuracy, 6) AS accuracy FROM pscore"),
    "permutation_importance": with_([*permuted_forest(), ("whole", """SELECT avg((pred = label)::INT) AS b FROM (SELECT row_id, label,
        (round(avg(p) - 0.5, 9) > 0)::INT AS pred FROM votes WHERE split = 'test' GROUP BY row_id, label)""")],
        "SELECT feature, round(avg(b - accuracy), 6) AS importance_mean, round(stddev_pop(b - accuracy), 6) AS importance_std FROM pscore, whole GROUP BY feature"),
    "boost_nodes": with_(BOOSTED, """SELECT tree AS tree_id, node AS node_id, feature, round(threshold, 8) AS threshold, n::BIGINT AS n_samples,
        round(h, 6) AS cover, round(value, 6) AS value, round(gain, 6) AS gain FROM bnodes"""),
    "boost_history": with_(BOOSTED, " UNION ALL ".join(f"""SELECT 'boost' AS model, split AS eval_set, {t} AS iteration,
        round(avg(CASE WHEN label = 1 THEN ln(1 + exp(-margin)) ELSE ln(1 + exp(margin)) END), 6) AS logloss,
        round(avg(((margin > 0)::INT = label)::INT), 6) AS accuracy FROM m{t + 1} GROUP BY split""" for t in range(BOOST.n_rounds))),
    "boost_scores": with_(BOOSTED, f"""SELECT round(1 / (1 + exp(-margin)), 4) AS p1, (1 / (1 + exp(-margin)) > 0.5)::INT AS prediction, count(*) AS n,
        sum(label)::BIGINT AS positives FROM m{BOOST.n_rounds} WHERE split = 'test' GROUP BY 1, 2"""),
    "split_gain_cover": with_(BOOSTED, """SELECT feature, count(*) AS weight, round(avg(gain), 6) AS gain, round(avg(h), 6) AS cover,
        round(avg(n), 6) AS mean_samples FROM bnodes WHERE f IS NOT NULL GROUP BY feature"""),
    "shap_values": with_(SHAP, "SELECT row_id, feature, value, round(phi, 6) AS phi FROM shap"),
    "shap_global": with_(SHAP, """SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi,
        round(covar_pop(phi, value) / nullif(stddev_pop(phi) * stddev_pop(value), 0), 6) AS direction FROM shap GROUP BY feature"""),
    "shap_local": with_(SHAP, "SELECT row_id, feature, value, round(phi, 6) AS phi FROM shap WHERE row_id = (SELECT min(row_id) FROM shap)"),
    "importance_by_model": with_([*BEST_BOTH, ("both_", """SELECT 'forest' AS model, * FROM nodes_imp UNION ALL SELECT 'tree', * FROM one_nodes_imp"""),
                                  ("rk", "SELECT *, rank() OVER (PARTITION BY model ORDER BY importance DESC)::INT AS rank FROM both_ QUALIFY rank <= 3")],
                                 "SELECT *, count(*) OVER (PARTITION BY feature) AS n_models FROM rk"),
    "interpretability_summary": with_([*BEST_BOTH, OOB], f"""SELECT 'tree' AS model, 1 AS n_trees, max(depth) AS depth, count(*) FILTER (f IS NULL) AS leaves,
        max(feature) FILTER (node = 0) AS top_feature, NULL::DOUBLE AS oob_score FROM one_nodes
        UNION ALL SELECT 'forest', n_trees, (SELECT max(depth) FROM nodes), (SELECT count(*) FROM nodes WHERE f IS NULL), (SELECT feature FROM nodes_imp ORDER BY importance DESC, feature LIMIT 1), oob_score
        FROM ({OOB_CURVE}) WHERE n_trees = {FOREST_TREES}"""),
}
