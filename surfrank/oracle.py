"""DuckDB SQL for the same computations, used as the correctness oracle.

Each (fixture, preset) becomes a chain of CTEs: lines -> parsed -> pages ->
edges / nodes -> one materialised CTE per iteration.  The SQL states the
semantics independently of the Spark plans (lists, ``unnest``, plain joins and
``GROUP BY``), so agreement checks the Spark side.  Regex dialect note: DuckDB
uses RE2, whose dot stops only at ``\\n``.  On the fixture WS, whose lines have the other
line separators, the Java rule is spelled as an explicit class; the others have none of them.
"""

from __future__ import annotations

from surfrank import fixtures as X
from surfrank.plans.presets import Preset, get_preset

# --- fixed values: markup patterns (RE2 spelling of the same rules) --------
TITLE_RE = "<title.*?>(.*?)</title>"
LINK_RE = r"\[\[(.*?)\]\]"
LINK_RE_NEWLINE_DOT = r"\[\[([^\n]*?)\]\]"
JAVA_DOT = r"[^\n\r\x{85}\x{2028}\x{2029}]"
TEXT_RE = "<text.*?>(.*?)</text>"
# ---------------------------------------------------------------------------

# Reported values are quantised to a binary grid of 2**-40 (about 9e-13).  A
# decimal rounding would put exactly representable decimal ranks (common with
# small N) on its ties, where last-bit summation noise flips the result.
RANK_SCALE = 2**40


def q(expr: str) -> str:
    """SQL twin of ``surfrank`` output quantisation."""
    return f"(round(({expr}) * {RANK_SCALE}::DOUBLE) / {RANK_SCALE}::DOUBLE)"


def _tabs(expr: str) -> str:
    return f"translate({expr}, chr(9), ' ')"


def title_sql(preset: Preset, v: str = "value") -> str:
    if preset.title_mode == "regex":
        t = f"CASE WHEN regexp_matches({v}, '{TITLE_RE}') THEN regexp_extract({v}, '{TITLE_RE}', 1) END"
    else:
        s = f"(CASE WHEN instr({v}, '<title>') = 0 THEN 6 ELSE instr({v}, '<title>') + 6 END)"
        close = f"instr({v}, '</title>')"
        if preset.on_bad_title == "slice":
            stop = f"(CASE WHEN {close} > 0 THEN {close} - 1 ELSE length({v}) - 1 END)"
            t = f"CASE WHEN {stop} > {s} THEN substring({v}, {s} + 1, {stop} - {s}) ELSE '' END"
        else:
            ok = f"{close} > 0 AND {close} - 1 >= {s}"
            good = f"substring({v}, {s} + 1, ({close} - 1) - {s})"
            bad = "error('unparsable page title')" if preset.on_bad_title == "error" else "NULL"
            t = f"CASE WHEN {ok} THEN {good} ELSE {bad} END"
    return _tabs(t) if preset.normalize_tabs else t


def links_sql(preset: Preset, v: str = "value") -> str:
    pat = LINK_RE if preset.link_dot == "java" else LINK_RE_NEWLINE_DOT
    if preset.text_scope:
        body = f"regexp_extract({v}, '{TEXT_RE}', 1)"
        links = (
            f"CASE WHEN regexp_matches({v}, '{TEXT_RE}') THEN regexp_extract_all({body}, '{pat}', 1) "
            "ELSE []::VARCHAR[] END"
        )
    else:
        links = f"regexp_extract_all({v}, '{pat}', 1)"
    if preset.normalize_tabs:
        links = f"list_transform({links}, lambda x: translate(x, chr(9), ' '))"
    return links


def kept_sql(preset: Preset, col: str = "outlinks") -> str:
    return f"list_filter({col}, lambda x: x <> '')" if preset.blank_links == "marker" else col


def consts_sql(preset: Preset, alpha: float, n: str = "n") -> tuple[str, str]:
    a = repr(float(alpha))
    if preset.alpha_precision == "float32":
        jump = f"CAST(CAST({a} AS FLOAT) / CAST({n} AS FLOAT) AS DOUBLE)"
        keep = f"CAST(CAST(1 AS FLOAT) - CAST({a} AS FLOAT) AS DOUBLE)"
    else:
        jump = f"{a}::DOUBLE / {n}"
        keep = f"1.0::DOUBLE - {a}::DOUBLE"
    return jump, keep


class Chain:
    """An ordered list of named CTEs rendered as one WITH clause."""

    def __init__(self) -> None:
        self.ctes: list[tuple[str, str, bool]] = []

    def add(self, name: str, sql: str, materialized: bool = False) -> str:
        if all(n != name for n, _, _ in self.ctes):
            self.ctes.append((name, sql.strip(), materialized))
        return name

    def sql(self, final: str) -> str:
        parts = [
            f"{n} AS {'MATERIALIZED ' if m else ''}(\n{s}\n)" for n, s, m in self.ctes
        ]
        return "WITH " + ",\n".join(parts) + "\n" + final.strip()


def lines_cte(ch: Chain, fx: str) -> str:
    return ch.add(f"{fx}_lines", X.lines_sql(fx), materialized=True)


def graph_ctes(ch: Chain, fx: str, preset: str | Preset) -> str:
    """Adds lines/parsed/stats/pages/edges/nodes CTEs; returns the name prefix."""
    p = get_preset(preset)
    pre = f"{fx}_{p.name}" + ("_text" if p.text_scope else "")
    lines = lines_cte(ch, fx)
    ch.add(f"{pre}_parsed", f"SELECT {title_sql(p)} AS title, {links_sql(p)} AS outlinks FROM {lines}", True)
    ch.add(f"{pre}_stats", f"SELECT count(*) AS n FROM {pre}_parsed")
    ch.add(
        f"{pre}_pages",
        f"SELECT title, outlinks, {kept_sql(p)} AS kept FROM {pre}_parsed WHERE title IS NOT NULL",
        True,
    )
    ch.add(
        f"{pre}_edges",
        f"""SELECT src, dst, count(*) AS mult
FROM (SELECT title AS src, unnest(kept) AS dst FROM {pre}_pages)
GROUP BY src, dst""",
        True,
    )
    ch.add(
        f"{pre}_nodes",
        f"""SELECT id, sum(d)::BIGINT AS outdeg
FROM (SELECT title AS id, len(kept)::BIGINT AS d FROM {pre}_pages
      UNION ALL
      SELECT unnest(outlinks) AS id, 0::BIGINT AS d FROM {pre}_pages)
GROUP BY id""",
        True,
    )
    return pre


def rank_ctes(ch: Chain, fx: str, preset: str | Preset, iterations: int, alpha: float = 0.15) -> str:
    """Adds r0..rk for a fixture; returns the name of the last iteration's CTE (id, outdeg, rank)."""
    p = get_preset(preset)
    pre = graph_ctes(ch, fx, p)
    jump, keep = consts_sql(p, alpha)
    ch.add(
        f"{pre}_consts",
        f"SELECT 1.0::DOUBLE / n AS init, {jump} AS jump, {keep} AS keepf FROM {pre}_stats",
    )
    ch.add(f"{pre}_r0", f"SELECT id, outdeg, (SELECT init FROM {pre}_consts) AS rank FROM {pre}_nodes", True)
    for i in range(1, iterations + 1):
        ch.add(
            f"{pre}_r{i}",
            f"""SELECT n.id, n.outdeg,
       (SELECT jump FROM {pre}_consts) + (SELECT keepf FROM {pre}_consts) * coalesce(s.s, 0.0) AS rank
FROM {pre}_nodes n
LEFT JOIN (SELECT e.dst AS id, sum(e.mult * (r.rank / r.outdeg)) AS s
           FROM {pre}_edges e JOIN {pre}_r{i - 1} r ON e.src = r.id
           GROUP BY e.dst) s ON n.id = s.id""",
            True,
        )
    return f"{pre}_r{iterations}"


def ranks_sql(fx: str, preset: str, iterations: int, alpha: float = 0.15, title: str = "title") -> str:
    ch = Chain()
    last = rank_ctes(ch, fx, preset, iterations, alpha)
    return ch.sql(f"SELECT id AS {title}, {q("rank")} AS rank FROM {last}")


def _plain(preset: str, **opts) -> Preset:
    return get_preset(preset).with_options(**opts)


def _joined(expr: str) -> str:
    return f"array_to_string({expr}, chr(31))"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _q_lines_only(fx_list, select_for) -> str:
    ch = Chain()
    for fx in fx_list:
        lines_cte(ch, fx)
    return ch.sql(_union([select_for(fx) for fx in fx_list]))


def _records_sql(fx: str) -> str:
    """Initial graph-state records of a fixture under the MR preset."""
    ch = Chain()
    last = rank_ctes(ch, fx, "mapreduce", 0)
    pre = f"{fx}_mapreduce"
    ch.add(
        f"{pre}_lists",
        f"""SELECT title, string_agg(dst, chr(31) ORDER BY dst) AS links
FROM (SELECT title, unnest(kept) AS dst FROM {pre}_pages) GROUP BY title""",
    )
    return ch.sql(
        f"""SELECT r.id AS title, {q("r.rank")} AS pageRank, r.outdeg AS n_links,
       coalesce(l.links, '') AS links, true AS isNode
FROM {last} r LEFT JOIN {pre}_lists l ON r.id = l.title"""
    )


def _trace_sql(fx: str, preset: str, iterations: int, alpha: float) -> str:
    ch = Chain()
    rank_ctes(ch, fx, preset, iterations, alpha)
    pre = f"{fx}_{preset}"
    return ch.sql(
        _union(
            [
                f"SELECT {i}::BIGINT AS iteration, id, {q("rank")} AS rank FROM {pre}_r{i}"
                for i in range(iterations + 1)
            ]
        )
    )


def _multi_ranks_sql(runs, alpha: float, label: str) -> str:
    """Union of (label, title, rank) over (label_value, fixture, preset, iterations)."""
    ch = Chain()
    parts = []
    for value, fx, preset, its in runs:
        last = rank_ctes(ch, fx, preset, its, alpha)
        lit = f"'{value}'" if isinstance(value, str) else f"{value}::BIGINT"
        parts.append(f"SELECT {lit} AS {label}, id AS title, {q("rank")} AS rank FROM {last}")
    return ch.sql(_union(parts))


JOB_RUNS = {
    "mapreduce": (("wp", 10), ("wh", 4), ("wd", 4)),
    "rdd_jvm": (("wp", 10), ("wh", 4)),
    "rdd_py": (("wp", 10), ("wh", 4), ("wd", 4)),
}


def all_queries(alpha: float = 0.15, sep: str = "\u001f") -> dict[str, str]:
    assert sep == "\u001f", "oracle joins link lists with chr(31)"
    out: dict[str, str] = {}
    regex_plain = _plain("mapreduce", normalize_tabs=False)
    slice_plain = _plain("rdd_py")
    strict_plain = _plain("rdd_py", on_bad_title="skip")
    java_links = links_sql(_plain("rdd_jvm"))
    py_links = links_sql(_plain("rdd_py"))
    mr = get_preset("mapreduce")

    # sources / sinks
    out["scan_lines"] = _q_lines_only(["wp"], lambda fx: f"SELECT value FROM {fx}_lines")
    out["page_count"] = _q_lines_only(
        ["wp", "wh", "wd"], lambda fx: f"SELECT '{fx}' AS fixture, count(*)::BIGINT AS n_lines FROM {fx}_lines"
    )
    out["sink_count_line"] = _q_lines_only(
        ["wd"], lambda fx: f"SELECT 'Total Pages-' || count(*) AS value, count(*)::BIGINT AS n_lines FROM {fx}_lines"
    )

    # extraction
    out["title_regex"] = _q_lines_only(["wd"], lambda fx: f"SELECT value, {title_sql(regex_plain)} AS title FROM {fx}_lines")
    out["title_positional"] = _q_lines_only(
        ["wd"],
        lambda fx: f"SELECT value, {title_sql(slice_plain)} AS title_slice, "
        f"{title_sql(strict_plain)} AS title_strict FROM {fx}_lines",
    )
    out["outlinks"] = _q_lines_only(
        ["wd", "wp"],
        lambda fx: f"SELECT value, len({java_links})::BIGINT AS n_links, {_joined(java_links)} AS links, "
        f"len({py_links})::BIGINT AS n_links_py FROM {fx}_lines",
    )
    out["outlinks_dot_rules"] = _q_lines_only(
        ["ws"],
        lambda fx: f"""SELECT value, CASE WHEN regexp_matches(value, '<title{JAVA_DOT}*?>({JAVA_DOT}*?)</title>')
  THEN regexp_extract(value, '<title{JAVA_DOT}*?>({JAVA_DOT}*?)</title>', 1) END AS title,
  {_joined(f"regexp_extract_all(value, '{LINK_RE.replace('.', JAVA_DOT)}', 1)")} AS links_java, {_joined(py_links)} AS links_py FROM {fx}_lines""",
    )
    out["normalize_tabs"] = _q_lines_only(
        ["wd"],
        lambda fx: f"SELECT value, {title_sql(mr)} AS title, {_joined(links_sql(mr))} AS links "
        f"FROM {fx}_lines",
    )
    scoped = links_sql(_plain("rdd_jvm", text_scope=True))
    out["outlinks_text_scope"] = _q_lines_only(
        ["wp", "wd"],
        lambda fx: f"SELECT value, len({scoped})::BIGINT AS n_links, {_joined(scoped)} AS links FROM {fx}_lines",
    )
    ch = Chain()
    pre = graph_ctes(ch, "wd", "mapreduce")
    out["parse_pages"] = ch.sql(
        f"SELECT title, len(outlinks)::BIGINT AS n_links, {_joined('outlinks')} AS links FROM {pre}_pages"
    )

    # graph
    ch = Chain()
    pre = graph_ctes(ch, "wd", "mapreduce")
    out["adjacency_mr"] = ch.sql(f"SELECT src, dst, mult FROM {pre}_edges")
    out["edges_mr"] = ch.sql(
        f"""SELECT key, value, count(*) AS n FROM (
  SELECT title AS key, unnest(outlinks) AS value FROM {pre}_pages WHERE len(outlinks) > 0
  UNION ALL SELECT unnest(outlinks) AS key, '' AS value FROM {pre}_pages
  UNION ALL SELECT title AS key, '' AS value FROM {pre}_pages WHERE len(outlinks) = 0)
GROUP BY key, value"""
    )
    ch = Chain()
    a = graph_ctes(ch, "wd", "mapreduce")
    b = graph_ctes(ch, "wd", "rdd_py")
    out["vertices"] = ch.sql(
        f"SELECT 'mapreduce' AS preset, id FROM {a}_nodes UNION ALL SELECT 'rdd_py' AS preset, id FROM {b}_nodes"
    )
    out["out_degree"] = ch.sql(
        f"SELECT 'mapreduce' AS preset, id, outdeg FROM {a}_nodes "
        f"UNION ALL SELECT 'rdd_py' AS preset, id, outdeg FROM {b}_nodes"
    )
    out["dangling_nodes"] = ch.sql(
        f"SELECT 'mapreduce' AS preset, id FROM {a}_nodes WHERE outdeg = 0 "
        f"UNION ALL SELECT 'rdd_py' AS preset, id FROM {b}_nodes WHERE outdeg = 0"
    )
    out["zero_mass"] = ch.sql(f"SELECT id, 0.0::DOUBLE AS mass FROM {b}_nodes")
    ch = Chain()
    pre = graph_ctes(ch, "wp", "mapreduce")
    out["edge_multiplicity"] = ch.sql(f"SELECT src, dst, mult FROM {pre}_edges")
    ch = Chain()
    pre = graph_ctes(ch, "wh", "rdd_py")
    out["adjacency"] = ch.sql(
        f"SELECT title, link, count(*) AS mult FROM (SELECT title, unnest(outlinks) AS link FROM {pre}_pages) "
        "GROUP BY title, link"
    )

    # one step
    ch = Chain()
    rank_ctes(ch, "wd", "mapreduce", 0, alpha)
    out["initial_rank"] = ch.sql(f"SELECT id, {q("rank")} AS rank FROM wd_mapreduce_r0")
    ch = Chain()
    rank_ctes(ch, "wp", "mapreduce", 0, alpha)
    p = "wp_mapreduce"
    out["contributions"] = ch.sql(
        f"""SELECT e.src, e.dst, {q("e.mult * (r.rank / r.outdeg)")} AS c
FROM {p}_edges e JOIN {p}_r0 r ON e.src = r.id"""
    )
    out["adjacency_with_rank"] = ch.sql(
        f"SELECT e.src, e.dst, e.mult, {q("r.rank")} AS rank FROM {p}_edges e JOIN {p}_r0 r ON e.src = r.id"
    )
    out["rank_sum"] = ch.sql(
        f"""SELECT id, {q("sum(c)")} AS s FROM (
  SELECT e.dst AS id, e.mult * (r.rank / r.outdeg) AS c FROM {p}_edges e JOIN {p}_r0 r ON e.src = r.id
  UNION ALL SELECT id, 0.0::DOUBLE AS c FROM {p}_nodes)
GROUP BY id"""
    )
    out["rank_step"] = ranks_sql("wd", "mapreduce", 1, alpha, title="id")
    out["rank_float32"] = ranks_sql("wh", "rdd_jvm", 3, alpha, title="id")

    # state records
    out["initial_state"] = _records_sql("wp")
    out["state_lines"] = _records_sql("wd")
    out["ranks_from_state"] = ranks_sql("wd", "mapreduce", 1, alpha)
    out["state_roundtrip"] = ranks_sql("wd", "mapreduce", 4, alpha)
    ch = Chain()
    rank_ctes(ch, "wd", "mapreduce", 0, alpha)
    p = "wd_mapreduce"
    msgs = f"""SELECT e.dst AS key, e.mult, r.rank / r.outdeg AS share
FROM {p}_edges e JOIN {p}_r0 r ON e.src = r.id"""
    out["rank_messages"] = ch.sql(
        f"SELECT key, {q("share")} AS share, sum(mult)::BIGINT AS n FROM ({msgs}) GROUP BY key, {q("share")}"
    )
    out["split_state"] = ch.sql(
        f"""SELECT n.id AS key, 1::BIGINT AS n_structure, coalesce(m.n_messages, 0)::BIGINT AS n_messages,
       {q("coalesce(m.msg_sum, 0.0)")} AS msg_sum
FROM {p}_nodes n LEFT JOIN (
  SELECT key, sum(mult)::BIGINT AS n_messages, sum(mult * share) AS msg_sum FROM ({msgs}) GROUP BY key) m
ON n.id = m.key"""
    )

    # loop, order, sinks, whole jobs
    out["rank_10"] = ranks_sql("wp", "mapreduce", 10, alpha)
    out["rank_10_hot_sources"] = ranks_sql("wk", "mapreduce", 10, alpha)
    out["rank_salted_sources"] = ranks_sql("wk", "mapreduce", 3, alpha)
    out["rank_dictionary"] = ranks_sql("wk", "mapreduce", 3, alpha)
    ch = Chain()
    last = rank_ctes(ch, "wk", "mapreduce", 2, alpha)
    out["kept_state"] = ch.sql(
        f"""SELECT r.id, r.outdeg, {q("r.rank")} AS rank, e.dst, e.mult FROM {last} r LEFT JOIN wk_mapreduce_edges e ON r.id = e.src"""
    )
    ch = Chain()
    last = rank_ctes(ch, "wd", "mapreduce", 2, alpha)
    out["ranked_repeated"] = ch.sql(f"SELECT row_number() OVER (ORDER BY {q("rank")} DESC, id) AS pos, id AS title, {q("rank")} AS rank FROM {last}")
    ch = Chain()
    last = rank_ctes(ch, "wp", "mapreduce", 10, alpha)
    out["ranked"] = ch.sql(
        f"""SELECT row_number() OVER (ORDER BY {q("rank")} DESC, id) AS pos, id AS title,
       {q("rank")} AS rank FROM {last}"""
    )
    out["rank_trace"] = _trace_sql("wp", "mapreduce", 3, alpha)
    out["rank_partitions"] = _multi_ranks_sql(
        [(2, "wp", "mapreduce", 5), (7, "wp", "mapreduce", 5)], alpha, "num_partitions"
    )
    wd_ranks = ranks_sql("wd", "mapreduce", 4, alpha)
    out["sink_ranked_order"] = f"""SELECT form, row_number() OVER (PARTITION BY form ORDER BY rank DESC, title) AS pos, title, rank
FROM ({wd_ranks}) CROSS JOIN (SELECT unnest(['tsv', 'tuple_jvm', 'tuple_py']) AS form)"""
    out["job_resumed"] = ranks_sql("wk", "mapreduce", 4, alpha)
    out["job_resumed_dictionary"] = ranks_sql("wk", "mapreduce", 4, alpha)
    out["job_resumed_text"] = ranks_sql("wd", "mapreduce", 4, alpha)
    out["rank_extractor"] = ranks_sql("wd", "mapreduce", 3, alpha)
    out["sink_ranked_tsv"] = ranks_sql("wd", "mapreduce", 4, alpha)
    out["sink_tuple_py"] = ranks_sql("wd", "rdd_py", 4, alpha)
    out["sink_tuple_jvm"] = ranks_sql("wh", "rdd_jvm", 4, alpha)
    for preset, runs in JOB_RUNS.items():
        out[f"job_{preset}"] = _multi_ranks_sql([(fx, fx, preset, its) for fx, its in runs], alpha, "fixture")
    return out
