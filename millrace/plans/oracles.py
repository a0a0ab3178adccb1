"""SQL for DuckDB that gives the rows of the queries."""

from __future__ import annotations

_MEMBERS = """
m AS (
  SELECT 'supplier_part' AS relation, 's' AS side, 'S' || s_suppkey AS uuid FROM supplier WHERE s_suppkey % 10 <> 0
  UNION ALL SELECT 'supplier_part', 't', 'P' || p_partkey FROM part
  UNION ALL SELECT 'customer_orders', 's', 'C' || c_custkey FROM customer
  UNION ALL SELECT 'customer_orders', 't', 'O' || o_orderkey FROM orders
  UNION ALL SELECT 'nation_customer', 's', 'N' || n_nationkey FROM nation
  UNION ALL SELECT 'nation_customer', 't', 'C' || c_custkey FROM customer
  UNION ALL SELECT 'region_nation', 's', 'R' || r_regionkey FROM region
  UNION ALL SELECT 'region_nation', 't', 'N' || n_nationkey FROM nation
  UNION ALL SELECT 'orders_region', 's', 'O' || o_orderkey FROM orders
  UNION ALL SELECT 'orders_region', 't', 'R' || r_regionkey FROM region)"""
_RELATIONS = """
rels(relation, source_type, target_type) AS (
  VALUES ('supplier_part', 'supplier', 'part'), ('customer_orders', 'customer', 'orders'),
    ('nation_customer', 'nation', 'customer'), ('region_nation', 'region', 'nation'), ('orders_region', 'orders', 'region'))"""


_ORIENTED = f"""{_MEMBERS},
e AS (
  SELECT 'supplier_part' AS relation,
    CASE WHEN l_linenumber % 3 = 0 THEN 'P' || l_partkey ELSE 'S' || l_suppkey END AS u0,
    CASE WHEN l_linenumber % 3 = 0 THEN 'S' || l_suppkey ELSE 'P' || l_partkey END AS u1 FROM lineitem
  UNION ALL SELECT 'customer_orders', 'C' || o_custkey, 'O' || o_orderkey FROM orders
  UNION ALL SELECT 'nation_customer', 'N' || c_nationkey, 'C' || c_custkey FROM customer
  UNION ALL SELECT 'region_nation', 'R' || n_regionkey, 'N' || n_nationkey FROM nation),
f AS (
  SELECT relation, u0, u1,
    EXISTS (SELECT 1 FROM m WHERE m.relation = e.relation AND side = 's' AND uuid = u0)
      AND EXISTS (SELECT 1 FROM m WHERE m.relation = e.relation AND side = 't' AND uuid = u1) AS kept,
    EXISTS (SELECT 1 FROM m WHERE m.relation = e.relation AND side = 's' AND uuid = u1)
      AND EXISTS (SELECT 1 FROM m WHERE m.relation = e.relation AND side = 't' AND uuid = u0) AS turned
  FROM e),
o AS (
  SELECT relation, CASE WHEN NOT kept AND turned THEN u1 ELSE u0 END AS s, CASE WHEN NOT kept AND turned THEN u0 ELSE u1 END AS t,
    NOT kept AND NOT turned AS ambiguous FROM f),
p AS (SELECT relation, s, t, count(*) AS n, count(*) FILTER (WHERE ambiguous) AS ambiguous FROM o GROUP BY ALL),
d AS (
  SELECT relation, 's' AS side, s AS uuid, CAST(sum(n) AS BIGINT) AS degree FROM p GROUP BY ALL
  UNION ALL SELECT relation, 't', t, CAST(sum(n) AS BIGINT) FROM p GROUP BY ALL)"""


_SUMMARY = """
es AS (
  SELECT relation, CAST(sum(n) AS BIGINT) AS total_edges, count(*) AS unique_pairs, CAST(sum(n - 1) AS BIGINT) AS duplicate_edges,
    count(*) FILTER (WHERE n > 1) AS pairs_with_duplicates, CAST(sum(n - 1) AS BIGINT) AS parallel_edges,
    max(n) AS parallel_max, CAST(sum(ambiguous) AS BIGINT) AS ambiguous_pairs FROM p GROUP BY relation),
ds AS (
  SELECT relation, side, count(*) AS connected_nodes, min(degree) AS degree_min, max(degree) AS degree_max, avg(degree) AS degree_avg
  FROM d GROUP BY ALL),
mt AS (SELECT relation, side, count(DISTINCT uuid) AS total_nodes FROM m GROUP BY ALL),
ss AS (
  SELECT mt.relation, mt.side, total_nodes, coalesce(connected_nodes, 0) AS connected_nodes, coalesce(degree_min, 0) AS degree_min,
    coalesce(degree_max, 0) AS degree_max, coalesce(degree_avg, 0.0) AS degree_avg FROM mt LEFT JOIN ds USING (relation, side)),
c AS (
  SELECT rels.relation, CASE WHEN a.degree_max IS NULL THEN 'empty' WHEN a.degree_max <= 1 AND b.degree_max <= 1 THEN 'one-to-one'
    WHEN b.degree_max <= 1 THEN 'one-to-many' WHEN a.degree_max <= 1 THEN 'many-to-one' ELSE 'many-to-many' END AS cardinality
  FROM rels LEFT JOIN ds a ON a.relation = rels.relation AND a.side = 's' LEFT JOIN ds b ON b.relation = rels.relation AND b.side = 't'),
st AS (
  SELECT rels.relation, source_type, target_type, coalesce(total_edges, 0) AS total_edges, coalesce(unique_pairs, 0) AS unique_pairs,
    coalesce(duplicate_edges, 0) AS duplicate_edges, coalesce(pairs_with_duplicates, 0) AS pairs_with_duplicates,
    coalesce(ambiguous_pairs, 0) AS ambiguous_pairs,
    x.total_nodes AS source_total_nodes, x.connected_nodes AS source_connected_nodes, x.degree_min AS source_degree_min,
    x.degree_max AS source_degree_max, x.degree_avg AS source_degree_avg,
    y.total_nodes AS target_total_nodes, y.connected_nodes AS target_connected_nodes, y.degree_min AS target_degree_min,
    y.degree_max AS target_degree_max, y.degree_avg AS target_degree_avg, cardinality
  FROM rels LEFT JOIN es USING (relation) JOIN ss x ON x.relation = rels.relation AND x.side = 's'
    JOIN ss y ON y.relation = rels.relation AND y.side = 't' JOIN c ON c.relation = rels.relation)"""


def _stats(select: str) -> str:
    return f"WITH {_RELATIONS}, {_ORIENTED}, {_SUMMARY} {select}"


_DISTRIBUTION = """
dd AS (
  SELECT relation, side, min(degree) AS degree_min, max(degree) AS degree_max, avg(degree) AS degree_avg,
    CAST(median(degree) AS DOUBLE) AS degree_median, CAST(quantile_disc(degree, 0.9) AS BIGINT) AS degree_p90,
    CAST(quantile_disc(degree, 0.99) AS BIGINT) AS degree_p99 FROM d GROUP BY ALL)"""

_OF_ISLANDS = """
n AS (SELECT relation, side, uuid, relation || ':' || side || ':' || uuid AS id FROM m),
l AS (
  SELECT DISTINCT a.id AS x, b.id AS y FROM p JOIN n a ON a.relation = p.relation AND a.side = 's' AND a.uuid = p.s
    JOIN n b ON b.relation = p.relation AND b.side = 't' AND b.uuid = p.t),
e2 AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(id, top) USING KEY (id) AS (
  SELECT id, id AS top FROM n
  UNION (SELECT e2.y, min(r.top) FROM r JOIN e2 ON e2.x = r.id JOIN recurring.r AS q ON q.id = e2.y WHERE r.top < q.top GROUP BY e2.y)),
i AS (SELECT n.relation, n.side, n.uuid, r.top AS island FROM n JOIN r USING (id)),
k AS (
  SELECT i.*, coalesce(d.degree, 0) AS degree, row_number() OVER (PARTITION BY island, i.side ORDER BY coalesce(d.degree, 0) DESC, i.uuid) AS rk
  FROM i LEFT JOIN d ON d.relation = i.relation AND d.side = i.side AND d.uuid = i.uuid),
z AS (
  SELECT relation, island, count(*) AS size_total, count(*) FILTER (WHERE side = 's') AS size_source,
    count(*) FILTER (WHERE side = 't') AS size_target,
    max(uuid) FILTER (WHERE side = 's' AND rk = 1) AS top_source_uuid, max(degree) FILTER (WHERE side = 's' AND rk = 1) AS top_source_degree,
    max(uuid) FILTER (WHERE side = 't' AND rk = 1) AS top_target_uuid, max(degree) FILTER (WHERE side = 't' AND rk = 1) AS top_target_degree
  FROM k GROUP BY ALL),
zs AS (
  SELECT relation, 's' AS side, island, size_source AS size, size_total, top_source_uuid AS top_uuid, top_source_degree AS top_degree FROM z WHERE size_source > 0
  UNION ALL SELECT relation, 't', island, size_target, size_total, top_target_uuid, top_target_degree FROM z WHERE size_target > 0),
zm AS (
  SELECT zs.*, size / sum(size) OVER (PARTITION BY relation, side) AS fraction FROM zs)
"""
_ISLANDS = f"WITH RECURSIVE {_ORIENTED}, {_OF_ISLANDS}"

_PIE = """,
pp AS (SELECT relation, side, island, size, CAST(sum(size) OVER (PARTITION BY relation, side) AS DOUBLE) AS total FROM zm WHERE size > 1),
pl AS (
  SELECT relation, side, island, CAST(size AS DOUBLE) / total AS part, row_number() OVER w - 1 AS rn, CAST(coalesce(sum(size) OVER (PARTITION BY relation, side
    ORDER BY size DESC, island ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / total AS start
  FROM pp WINDOW w AS (PARTITION BY relation, side ORDER BY size DESC, island)),
pc AS (SELECT *, CAST(rn % 6 AS INTEGER) AS idx, CASE WHEN part > 0.05 THEN 1.0::DOUBLE ELSE (part / 0.05) * (part / 0.05) END AS t FROM pl)
SELECT relation, side, island, idx, part, start,
  CAST(floor(55 + t * ([235, 220, 15, 0, 160, 255][idx + 1] - 55) + 0.5) AS INTEGER) AS r,
  CAST(floor(65 + t * ([10, 120, 170, 150, 60, 0][idx + 1] - 65) + 0.5) AS INTEGER) AS g,
  CAST(floor(81 + t * ([10, 0, 0, 220, 255, 170][idx + 1] - 81) + 0.5) AS INTEGER) AS b FROM pc"""


def _profile(values: str, counts: str) -> str:
    return f"""WITH v AS ({values}), n AS ({counts}),
g AS (SELECT type, name, count(*) AS count, count(DISTINCT v) AS unique_count FROM v WHERE v <> '' GROUP BY ALL),
q AS (
  SELECT type, name, type_count, count, count / type_count * 100 AS pct, unique_count, unique_count / count * 100 AS unique_pct,
    CAST(row_number() OVER (PARTITION BY type ORDER BY count DESC, name) AS INTEGER) AS rank FROM g JOIN n USING (type))"""


def _columns(kind: str, columns: list[str], table: str | None = None) -> str:
    return " UNION ALL ".join(f"SELECT '{kind}' AS type, '{c}' AS name, CAST({c} AS VARCHAR) AS v FROM {table or kind}" for c in columns)


_CUSTOMER = """(SELECT c_name, nullif(c_nationkey, 0) AS c_nationkey, c_acctbal,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer)"""
_VALUES = {
    "customer": _columns("customer", ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], _CUSTOMER),
    "supplier": _columns("supplier", ["s_name", "s_nationkey", "s_acctbal"]),
    "part": _columns("part", ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
    "nation": _columns("nation", ["n_name", "n_regionkey"]),
}
_COUNTS = {k: f"SELECT '{k}' AS type, count(*) AS type_count FROM {k}" for k in _VALUES}
_ALL = _profile(" UNION ALL ".join(_VALUES.values()), " UNION ALL ".join(_COUNTS.values()))
_TIER = "CASE WHEN pct >= 100 THEN 'required' WHEN pct >= 10 THEN 'common' ELSE 'rare' END"
_LABEL = "CASE WHEN coalesce(name, '') <> '' THEN name || ' (' || {0} || ')' ELSE {0} END AS label"
_REL_TYPES = """rt(tech, name, about, sn, st, tn, tt) AS (VALUES
    ('supplier_part', 'Supplies', '  What a supplier has,' || chr(10) || repeat('z', 80), 'Supplier', 'supplier', NULL, 'part'),
    ('customer_orders', '', NULL, 'Customer', 'customer', 'Order', 'orders'),
    ('nation_customer', 'Has', ' customers of a nation ', '', 'nation', 'Customer', NULL),
    ('orders_region', NULL, '', NULL, NULL, 'Region', 'region'))"""
_END = "CASE WHEN coalesce({1}, '') = '' THEN '?' WHEN coalesce({0}, '') <> '' THEN {0} || ' (' || {1} || ')' ELSE {1} END"
_LABELS = """CASE WHEN n_nationkey % 4 = 0 THEN CASE WHEN n_nationkey % 3 = 0 THEN 'codelist' ELSE 'other' END || ',l'
    WHEN n_nationkey % 3 = 0 THEN CASE WHEN n_nationkey % 2 = 0 THEN 'codelist' ELSE 'other' END || ',d' ELSE '' END"""
_NODES = f"""nt AS (SELECT 'T' || n_nationkey AS tech, n_nationkey AS k, n_name, {_LABELS} AS labels,
    CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'listed ' || n_name END AS name, CASE WHEN n_nationkey % 5 < 3 THEN 'application' ELSE 'system' END AS type
  FROM nation)"""
_FILES = """
ed AS (
  SELECT 'region_nation' AS relation, CASE WHEN n_nationkey % 5 = 1 THEN 'N' || n_nationkey ELSE 'R' || n_regionkey END AS u0,
    CASE WHEN n_nationkey % 5 = 1 THEN 'R' || n_regionkey WHEN n_nationkey = 8 THEN 'None' ELSE 'N' || n_nationkey END AS u1
  FROM nation WHERE n_nationkey NOT IN (7, 9)
  UNION ALL SELECT 'nation_nation', 'N' || n_nationkey, 'N' || n_nationkey FROM nation, range(2)),
nd AS (
  SELECT 'region' AS type, 'R' || r_regionkey AS uuid FROM region
  UNION ALL SELECT 'nation', 'N' || n_nationkey FROM nation WHERE n_nationkey NOT IN (3, 4))"""
_FETCHED = """
x AS (SELECT r_name, r_regionkey AS k, n_regionkey, n_nationkey, n_name, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) AS nth
  FROM region LEFT JOIN nation ON n_regionkey = r_regionkey AND n_regionkey <> 0)"""
_SNAPSHOTS = """
f AS (
  SELECT year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate) AS date, o_orderdate AS moment, o_orderpriority AS stem,
    CASE WHEN o_orderkey % 5 = 0 THEN 'h' WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'r' END AS kind FROM orders),
i AS (
  SELECT date, min(moment) AS moment, coalesce(string_agg(DISTINCT stem, '|' ORDER BY stem) FILTER (WHERE kind = 'a'), '') AS node_types,
    coalesce(string_agg(DISTINCT stem, '|' ORDER BY stem) FILTER (WHERE kind = 'r'), '') AS relations
  FROM f GROUP BY date HAVING count(*) FILTER (WHERE kind <> 'h') > 0)"""
_TAU = "2 * pi() * 24"

SQL = {
    "rel_stats_v1_supplier_part": _stats("SELECT * FROM st WHERE relation = 'supplier_part'"),
    "rel_stats_all": _stats("SELECT * FROM st"),
    "rel_orientation": f"WITH {_ORIENTED} SELECT * FROM o WHERE relation = 'supplier_part'",
    "rel_edge_summary": _stats("SELECT * FROM es"),
    "rel_side_summary": _stats("SELECT * FROM ss"),
    "rel_cardinality_all": _stats("SELECT * FROM c"),
    "rel_degree_distribution": f"WITH {_ORIENTED}, {_DISTRIBUTION} SELECT * FROM dd",
    "rel_parallel_pairs": f"""WITH {_ORIENTED} SELECT relation, s, t, n, CAST(row_number() OVER (ORDER BY n DESC, s, t) AS INTEGER) AS rank
      FROM p WHERE n > 1 AND relation = 'supplier_part'""",
    "rel_top_nodes": f"""WITH {_ORIENTED},
      k AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY degree DESC, uuid) AS rank FROM d WHERE relation = 'supplier_part'),
      x AS (SELECT 'S' || s_suppkey AS uuid, s_name AS name, CAST(s_suppkey AS VARCHAR) AS code FROM supplier
        UNION ALL SELECT 'P' || p_partkey, '', CAST(p_partkey AS VARCHAR) FROM part)
      SELECT relation, side, k.uuid, degree, CAST(rank AS INTEGER) AS rank, coalesce(nullif(name, ''), '(unnamed)') AS name, code
      FROM k LEFT JOIN x ON x.uuid = k.uuid WHERE rank <= 10""",
    "rel_coverage_pie": _stats(f""", x AS (
      SELECT relation, 's' AS side, source_total_nodes AS total, source_connected_nodes AS connected, total_edges, duplicate_edges FROM st
      UNION ALL SELECT relation, 't', target_total_nodes, target_connected_nodes, total_edges, duplicate_edges FROM st),
      y AS (SELECT *, CASE WHEN total > 0 AND total_edges <> 0 THEN greatest(0.0, least(1.0::DOUBLE, connected / total)) END AS a,
        CASE WHEN total > 0 AND total_edges <> 0 THEN greatest(0.0, least(1.0::DOUBLE, duplicate_edges / total_edges)) END AS b FROM x)
      SELECT relation, side, total, connected, CASE WHEN total > 0 THEN printf('%.1f', connected / total * 100) || '%' ELSE 'n/a' END AS coverage_text, round(a, 9) AS connected_share, round(b, 9) AS parallel_share,
        round(a * {_TAU}, 9) AS connected_arc, round(b * {_TAU}, 9) AS parallel_arc FROM y"""),
    "rel_degree_view": f"""WITH {_ORIENTED}, {_DISTRIBUTION} SELECT relation, side, CAST(degree_min AS VARCHAR) AS min_text,
      CAST(degree_max AS VARCHAR) AS max_text, CAST(degree_p90 AS VARCHAR) AS p90_text, CAST(degree_p99 AS VARCHAR) AS p99_text,
      printf('%.3f', degree_avg) AS avg_text, regexp_replace(CAST(degree_median AS VARCHAR), '\\.0$', '') AS median_text FROM dd""",
    "rel_view": _stats(f""", {_REL_TYPES}
      SELECT relation, CASE WHEN tech IS NULL THEN 'No metadata for this relation.' END AS message,
        CASE WHEN tech IS NOT NULL THEN {_END.format("sn", "st")} END AS source_label, CASE WHEN tech IS NOT NULL THEN {_END.format("tn", "tt")} END AS target_label,
        CASE WHEN tech IS NOT NULL THEN coalesce(nullif(name, ''), relation) END AS title,
        CASE WHEN tech IS NULL THEN NULL WHEN trim(coalesce(about, ''), ' ' || chr(10)) = '' THEN '(missing description)'
          WHEN length(trim(about, ' ' || chr(10))) > 80 THEN left(trim(about, ' ' || chr(10)), 77) || '…' ELSE trim(about, ' ' || chr(10)) END AS description,
        CASE WHEN tech IS NOT NULL THEN total_edges || ' edges' END AS edges_text, CASE WHEN tech IS NOT NULL THEN unique_pairs || ' unique pairs' END AS pairs_text,
        CASE WHEN tech IS NOT NULL THEN CASE WHEN duplicate_edges = 1 THEN '1 parallel edge' ELSE duplicate_edges || ' parallel edges' END END AS parallel_text,
        CASE WHEN tech IS NOT NULL THEN duplicate_edges > 0 END AS parallel_alert,
        CASE WHEN tech IS NOT NULL THEN 'cardinality: ' || cardinality END AS cardinality_text
      FROM st LEFT JOIN rt ON tech = relation"""),
    "rel_profiles": f"""WITH RECURSIVE {_RELATIONS}, {_ORIENTED}, {_SUMMARY}, {_DISTRIBUTION}, {_OF_ISLANDS}, {_REL_TYPES},
      x AS (SELECT *, row_number() OVER (PARTITION BY relation, side ORDER BY degree DESC, uuid) AS k FROM d),
      iz AS (SELECT relation, count(*) AS islands, count(*) FILTER (WHERE size_total = 1) AS singletons FROM z GROUP BY relation),
      iy AS (SELECT *, row_number() OVER (PARTITION BY relation ORDER BY size_total DESC, island) AS k FROM z WHERE size_total > 1),
      it AS (SELECT relation, count(*) AS target_islands, max(size) FILTER (WHERE size > 1) AS target_largest FROM zs WHERE side = 't' GROUP BY relation)
      SELECT tech AS relation_name, rt.name, rt.st AS source_type, rt.tn AS target_name, st.total_edges AS edges_total, st.unique_pairs,
        coalesce(es.parallel_edges, 0) AS parallel_edges, coalesce(es.parallel_max, 0) AS parallel_max, st.source_total_nodes AS source_total,
        st.target_connected_nodes AS target_connected, st.cardinality, a.degree_p90 AS source_p90, b.degree_median AS target_median,
        x1.uuid AS top_source, x2.degree AS top_target_degree, iz.islands, iz.singletons, iy.size_total AS largest, iy.top_source_uuid AS largest_top,
        it.target_islands, it.target_largest, CASE WHEN es.parallel_max > 1 THEN es.parallel_max END AS most_parallel,
        CASE WHEN tech = 'supplier_part' THEN 'z,a' ELSE '' END AS attributes, CAST(0 AS BIGINT) AS source_min, CAST(NULL AS BIGINT) AS source_max
      FROM rt JOIN st ON st.relation = tech LEFT JOIN es ON es.relation = tech LEFT JOIN dd a ON a.relation = tech AND a.side = 's'
        LEFT JOIN dd b ON b.relation = tech AND b.side = 't' LEFT JOIN x x1 ON x1.relation = tech AND x1.side = 's' AND x1.k = 1
        LEFT JOIN x x2 ON x2.relation = tech AND x2.side = 't' AND x2.k = 1 LEFT JOIN iz ON iz.relation = tech
        LEFT JOIN iy ON iy.relation = tech AND iy.k = 1 LEFT JOIN it ON it.relation = tech""",
    "islands_components": f"{_ISLANDS} SELECT * FROM i",
    "islands_summary": f"""{_ISLANDS} SELECT relation, CAST(sum(size_total) AS BIGINT) AS total_nodes, count(*) AS total_islands,
      count(*) FILTER (WHERE size_total = 1) AS singleton_islands FROM z GROUP BY relation""",
    "rel_profile_lists": f"""{_ISLANDS},
      a AS (SELECT 'multi_islands' AS list, relation, CAST(NULL AS VARCHAR) AS side, island AS entry, size_total AS amount,
          size_total / sum(size_total) OVER (PARTITION BY relation) AS fraction, top_source_uuid AS top_uuid, top_target_degree AS top_degree FROM z
        UNION ALL SELECT 'side_islands', relation, side, island, size, fraction, top_uuid, top_degree FROM zm
        UNION ALL SELECT 'parallel_pairs', relation, NULL, s || '>' || t, n, NULL, NULL, NULL FROM p)
      SELECT *, CAST(row_number() OVER (PARTITION BY list, relation, side ORDER BY amount DESC,
        CASE list WHEN 'parallel_pairs' THEN split_part(entry, '>', 1) ELSE entry END, entry) AS INTEGER) AS rank FROM a WHERE amount > 1""",
    "islands_multi": f"""{_ISLANDS} SELECT * FROM (SELECT *, size_total / sum(size_total) OVER (PARTITION BY relation) AS fraction_total FROM z)
      WHERE size_total > 1""",
    "islands_side": f"""{_ISLANDS} SELECT relation, side, CAST(sum(size) AS BIGINT) AS total_nodes, count(*) AS total_islands,
      count(*) FILTER (WHERE size = 1) AS singleton_islands FROM zs GROUP BY ALL""",
    "islands_side_multi": f"{_ISLANDS} SELECT * FROM zm WHERE size > 1",
    "islands_pie_layout": _ISLANDS + _PIE,
    "attr_profile_customer": _profile(_VALUES["customer"], _COUNTS["customer"]) + " SELECT * FROM q",
    "attr_profile_all_types": _ALL + " SELECT * FROM q",
    "attr_profile_texts": _profile(
        " UNION ALL ".join(f"SELECT '{t}' AS type, '{c}' AS name, CAST({c} AS VARCHAR) AS v FROM {t}" for t, c in (
            ("documents", "text"), ("documents", "lang"), ("documents", "source"), ("pages", "url"), ("pages", "html"))),
        " UNION ALL ".join(f"SELECT '{t}' AS type, count(*) AS type_count FROM {t}" for t in ("documents", "pages")),
    )
    + " SELECT * FROM q",
    "attr_profile_json_props": _profile(
        """SELECT 'events' AS type, 'k' AS name, json_extract_string(props, '$.k') AS v FROM events
        UNION ALL SELECT 'events', 'kind', CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END FROM events""",
        "SELECT 'events' AS type, count(*) AS type_count FROM events",
    )
    + " SELECT * FROM q",
    "attr_tiers": _ALL + f" SELECT type, name, {_TIER} AS tier FROM q",
    "attr_search_limit": _ALL + """ SELECT type, name, rank, count FROM (
      SELECT *, row_number() OVER (PARTITION BY type ORDER BY rank) AS k FROM q WHERE contains(lower(name), 'na')) WHERE k <= 2""",
    "attr_metadata_join": _ALL + f""", a(type, name, shown, described, mandatory) AS (
      VALUES ('customer', 'c_name', 'Name', 'The customer''s name', 'critical'), ('customer', 'c_acctbal', 'Balance', '  ', NULL),
        ('supplier', 's_name', NULL, repeat('x', 101), NULL), ('part', 'p_size', 'Size', repeat('y', 100), 'optional'))
      SELECT q.type, q.name, CASE WHEN coalesce(shown, '') <> '' THEN shown || ' (' || q.name || ')' ELSE q.name END
          || CASE WHEN mandatory = 'critical' THEN ' *' ELSE '' END AS display_name,
        CASE WHEN trim(coalesce(described, '')) = '' THEN '(missing attribute description)'
          WHEN length(described) > 100 THEN left(described, 99) || '…' ELSE described END AS subtitle,
        CAST(unique_count AS VARCHAR) AS unique_cell, {_TIER} AS tier, printf('%.3f', pct) || '%' AS pct_text,
        CASE WHEN pct < 3 THEN '12px' ELSE printf('%.2f', pct) || '%' END AS bar,
        CASE WHEN pct * (unique_pct / 100) < 5 THEN '6px' ELSE 'calc(' || printf('%.2f', pct * (unique_pct / 100)) || '% - 2 * 3px)' END AS unique_bar FROM q LEFT JOIN a ON a.type = q.type AND a.name = q.name""",
    "attr_summary_text": "WITH n AS (" + " UNION ALL ".join(_COUNTS.values()) + """) SELECT type, type_count,
      CASE WHEN type_count > 0 THEN type_count || ' objects in ' || type || '. Showing attribute coverage.'
        ELSE 'No objects for ' || type || '.' END AS summary FROM n""",
    "type_kind_filter": f"""WITH {_NODES},
      t AS (SELECT *, type = 'application' AS app, type = 'system' AS sys, type = 'application' AND starts_with(labels, 'codelist') AS code FROM nt),
      k AS (SELECT tech AS shown FROM nt UNION ALL SELECT DISTINCT c_mktsegment FROM customer),
      x AS (SELECT * FROM k LEFT JOIN t ON tech = shown), f(filter) AS (VALUES ('application'), ('codelist'), ('system'), ('none'), ('curated')),
      m(metadata) AS (VALUES ('there'), ('missing'), ('broken')),
      y AS (SELECT metadata, filter, shown, CASE WHEN metadata = 'there' THEN name END AS name FROM x, f, m
        WHERE CASE WHEN filter = 'curated' THEN shown IN ('T3', 'BUILDING', 'AFRICA', '1-URGENT', 'absent') WHEN filter = 'none' OR metadata <> 'there' THEN true
          WHEN filter = 'application' THEN app AND NOT code WHEN filter = 'codelist' THEN code ELSE sys END)
      SELECT metadata, filter, shown AS type, {_LABEL.format("shown")} FROM y""",
    "relation_kind_filter": f"""WITH {_FETCHED},
      t AS (SELECT r_name AS tech, CASE WHEN k % 2 = 0 THEN r_name WHEN k = 3 THEN 'listed ' || r_name END AS name,
        CASE WHEN k = 3 THEN 'application' WHEN k <> 1 THEN 'system' END AS kind FROM x WHERE nth = 1),
      n AS (SELECT r_name AS relation FROM region UNION ALL SELECT DISTINCT o_orderpriority FROM orders),
      f(filter) AS (VALUES ('application'), ('system'), ('none'), ('curated'), ('both')), m(metadata) AS (VALUES ('there'), ('missing'), ('broken')),
      y AS (SELECT metadata, filter, relation, CASE WHEN metadata = 'there' THEN name END AS name FROM n LEFT JOIN t ON tech = relation, f, m
        WHERE CASE WHEN filter = 'curated' THEN relation IN ('T3', 'BUILDING', 'AFRICA', '1-URGENT', 'absent') WHEN filter = 'none' THEN true
          WHEN metadata <> 'there' THEN false WHEN filter = 'both' THEN kind IN ('application', 'system') ELSE kind = filter END)
      SELECT metadata, filter, relation, {_LABEL.format("relation")}, CAST(row_number() OVER (PARTITION BY metadata, filter ORDER BY relation) AS INTEGER) AS rank
      FROM y""",
    "default_selection": """SELECT 'kept' AS situation, n_name AS chosen FROM nation WHERE n_nationkey = 3 UNION ALL SELECT 'gone', CAST(NULL AS VARCHAR)
      UNION ALL SELECT x, (SELECT min(n_name) FROM nation WHERE n_nationkey > 4) FROM (VALUES ('first'), ('none')) t(x)""",
    "type_icon_kind": f"""WITH {_NODES} SELECT tech AS "technicalName", CASE WHEN type = 'application' AND NOT starts_with(labels, 'codelist') THEN 'application'
      WHEN type = 'system' THEN 'system' ELSE 'codelist' END AS kind FROM nt""",
    "metadata_first_endpoint": """SELECT r_name AS "technicalName", n_name AS source_name FROM region LEFT JOIN (
      SELECT n_regionkey, arg_min(n_name, n_nationkey) AS n_name FROM nation WHERE n_regionkey <> 0 GROUP BY ALL) ON n_regionkey = r_regionkey""",
    "metadata_relation_entries": f"""WITH {_FETCHED} SELECT r_name AS "technicalName",
        CASE WHEN k % 2 = 0 THEN r_name WHEN k = 3 THEN 'listed ' || r_name END AS name, CASE WHEN k > 1 THEN 'of the list' END AS description,
        CASE WHEN k = 3 THEN 'application' WHEN k <> 1 THEN 'system' END AS type, 'N' || n_nationkey AS source_type, n_name AS source_name,
        CASE WHEN n_name IS NOT NULL THEN 'application' END AS source_kind, 0 AS n_labels, CAST(NULL AS VARCHAR) AS target_type FROM x WHERE nth = 1""",
    "metadata_node_entries": f"""WITH {_NODES} SELECT tech AS "technicalName", name, type, labels, type = 'application' AS is_application,
      type = 'system' AS is_system, type = 'application' AND starts_with(labels, 'codelist') AS is_codelist FROM nt""",
    "metadata_index_document": f"""WITH {_NODES}, a(name) AS (VALUES ('z'), ('a'))
      SELECT tech AS type, type AS "typeKind", type = 'application' AND starts_with(labels, 'codelist') AS "isCodelist", a.name,
        CASE a.name WHEN 'z' THEN n_name || '!' WHEN 'a' THEN 'Ay' END AS attribute_name, CASE WHEN a.name IS NOT NULL THEN 'optional' END AS mandatory,
        CASE WHEN a.name IS NOT NULL THEN k % 2 = 0 END AS opendata, CASE WHEN a.name IS NOT NULL THEN k % 3 = 0 END AS invisible
      FROM nt LEFT JOIN a ON k % 7 <> 6""",
    "metadata_attr_map": """SELECT CAST(n_regionkey AS VARCHAR) AS type, 'a' || n_nationkey % 4 AS name, arg_max(n_name, n_nationkey) AS attribute_name,
      'optional' AS mandatory, true AS opendata, false AS invisible, false AS "readOnly" FROM nation WHERE n_nationkey % 7 <> 0 GROUP BY 1, 2""",
    "snapshot_index": f"WITH {_SNAPSHOTS} SELECT date, node_types, relations FROM i",
    "snapshot_latest": f"""WITH {_SNAPSHOTS} SELECT 'lexicographic' AS mode, max(date) AS date FROM i
      UNION ALL SELECT 'chronological', arg_max(date, moment) FROM i""",
    "snapshot_folders": f"""WITH {_SNAPSHOTS.replace("year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)", "year(o_orderdate) || '-1-1'")}
      SELECT date, node_types, relations FROM i""",
    "snapshot_lookup": _profile(_VALUES["customer"], _COUNTS["customer"]) + " SELECT type, type_count, name, count, pct, unique_count, unique_pct FROM q",
    "edge_table_files": f"WITH {_FILES} SELECT * FROM ed",
    "node_dump_files": f"WITH {_FILES} SELECT * FROM nd",
    "edge_table_large": "SELECT 'customer_orders' AS relation, 'C' || o_custkey AS u0, 'O' || o_orderkey AS u1 FROM orders",
    "table_rows_large": """SELECT 'customer_orders' AS stem, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS row, 'from|to|note' AS headers,
      'C' || o_custkey || '| O' || o_orderkey || '|}{"' || o_orderpriority AS row_values FROM orders""",
    "node_dump_large": "SELECT 'customer' AS type, 'C' || c_custkey AS uuid FROM customer UNION ALL SELECT 'supplier', 'S' || s_suppkey FROM supplier",
    "metadata_listed_details": """WITH x AS (SELECT n_nationkey AS k, n_name, CASE WHEN n_nationkey % 5 < 3 THEN 'application' ELSE 'system' END AS kind FROM nation)
      SELECT 'T' || k AS "technicalName", CASE WHEN k % 2 = 0 THEN n_name ELSE 'listed ' || CASE WHEN k % 6 = 0 THEN '1 ' ELSE '0 ' END || n_name END AS name,
        kind AS type, CASE WHEN k % 3 = 0 THEN 'codelist' ELSE 'other' END AS labels, kind = 'application' AS is_application, kind = 'system' AS is_system,
        kind = 'application' AND k % 3 = 0 AS is_codelist FROM x WHERE k % 4 <> 3""",
    "rest_lists": "SELECT r_name, n_name AS listed FROM nation JOIN region ON n_regionkey = r_regionkey",
    "relation_stats_command": f"""WITH {_FILES},
      k(relation_name, source_type, target_type) AS (VALUES ('region_nation', 'region', 'nation'), ('nation_nation', 'nation', 'nation')),
      f AS (SELECT k.*, u0, u1, EXISTS (SELECT 1 FROM nd WHERE type = source_type AND uuid = u0) AND EXISTS (SELECT 1 FROM nd WHERE type = target_type AND uuid = u1) AS kept,
        EXISTS (SELECT 1 FROM nd WHERE type = source_type AND uuid = u1) AND EXISTS (SELECT 1 FROM nd WHERE type = target_type AND uuid = u0) AS turned
        FROM ed JOIN k ON relation_name = relation),
      o AS (SELECT relation_name, source_type, target_type, CASE WHEN NOT kept AND turned THEN u1 ELSE u0 END AS s,
        CASE WHEN NOT kept AND turned THEN u0 ELSE u1 END AS t, NOT kept AND NOT turned AS bad FROM f),
      ns AS (SELECT relation_name, s, count(*) AS n FROM o GROUP BY ALL), nt AS (SELECT relation_name, t, count(*) AS n FROM o GROUP BY ALL),
      e AS (SELECT relation_name, source_type, target_type, count(*) AS total_edges, count(DISTINCT (s, t)) AS unique_pairs,
        count(*) - count(DISTINCT (s, t)) AS duplicate_edges, count(*) FILTER (WHERE bad) AS ambiguous_pairs FROM o GROUP BY ALL)
      SELECT '2025-11-3' AS snapshot, e.*, (SELECT count(*) FROM (SELECT s, t FROM o WHERE o.relation_name = e.relation_name GROUP BY ALL HAVING count(*) > 1)) AS pairs_with_duplicates,
        (SELECT count(*) FROM nd WHERE type = source_type) AS source_total_nodes, (SELECT count(*) FROM nd WHERE type = target_type) AS target_total_nodes,
        (SELECT count(*) FROM ns WHERE ns.relation_name = e.relation_name) AS source_connected_nodes, (SELECT count(*) FROM nt WHERE nt.relation_name = e.relation_name) AS target_connected_nodes,
        (SELECT max(n) FROM ns WHERE ns.relation_name = e.relation_name) AS source_degree_max, (SELECT max(n) FROM nt WHERE nt.relation_name = e.relation_name) AS target_degree_max,
        CASE WHEN relation_name = 'region_nation' THEN 'one-to-many' ELSE 'many-to-many' END AS cardinality FROM e""",
    "table_flatten": """WITH r AS (SELECT CAST(row_number() OVER (ORDER BY CAST(r_regionkey AS VARCHAR)) - 1 AS INTEGER) AS row, * FROM region)
      SELECT 'region' AS stem, row, 0 AS col, 'key' AS header, CAST(r_regionkey AS VARCHAR) AS value FROM r
      UNION ALL SELECT 'region', row, 1, 'name', r_name || ' "x";' FROM r UNION ALL SELECT 'region', row, 2, 'note', NULL FROM r""",
    "table_csv_lines": """SELECT 'region' AS stem, CAST(row_number() OVER (ORDER BY CAST(r_regionkey AS VARCHAR)) - 1 AS INTEGER) AS row,
        '"' || r_regionkey || '";"' || replace(r_name || ' "x";', '"', '""') || '";""' AS line FROM region
      UNION ALL SELECT 'region', -1, chr(65279) || '"key";"name";"note"'""",
    "table_csv_files": """SELECT 'region' AS stem, 0 AS row, chr(65279) || '"key";"name";"note"' AS line
      UNION ALL SELECT 'region', CAST(row_number() OVER (ORDER BY CAST(r_regionkey AS VARCHAR)) AS INTEGER),
        '"' || r_regionkey || '";"' || replace(r_name || ' "x";', '"', '""') || '";""' FROM region""",
    "text_truncate": r"""SELECT doc_id, CASE WHEN length(text) > 100 THEN left(text, 99) || '…' ELSE text END AS short,
      CASE WHEN coalesce(x, '') = '' THEN '(missing description)' WHEN length(x) > 80 THEN left(x, 77) || '…' ELSE x END AS shorter
      FROM (SELECT doc_id, text, regexp_replace(text, '^\s+|\s+$', '', 'g') AS x FROM documents)""",
    "text_escape": """SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')
      AS escaped FROM pages""",
    "text_url": """SELECT page_id, replace(replace(replace(replace(replace(url_encode(url || ' č(1)!''*~+'), '%28', '('), '%29', ')'), '%21', '!'), '%27', chr(39)), '%2A', '*')
      AS escaped FROM pages""",
    "text_rgba": """SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN p_size ELSE 1 END AS DOUBLE) AS r,
      CAST(CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE p_size END AS DOUBLE) AS g, CAST(CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 ELSE 255 END AS DOUBLE) AS b,
      CAST(CASE WHEN p_partkey % 4 < 2 THEN 1 ELSE 0.25 END AS DOUBLE) AS a FROM part""",
    "pct_format": """WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 8 NOT IN (0, 7) THEN CAST(p_size AS DOUBLE) / pow(10.0, p_partkey % 8 - 1) / 3.0 END AS v FROM part),
      y AS (SELECT *, least(8, greatest(2, ceil(-log10(v)) + 1)) AS n FROM x)
      SELECT p_partkey, CASE WHEN v IS NULL THEN '0%' WHEN v >= 0.01 THEN printf('%.3f', v) || '%' ELSE rtrim(rtrim(CASE n WHEN 3 THEN printf('%.3f', v)
        WHEN 4 THEN printf('%.4f', v) WHEN 5 THEN printf('%.5f', v) WHEN 6 THEN printf('%.6f', v) WHEN 7 THEN printf('%.7f', v)
        ELSE printf('%.8f', v) END, '0'), '.') || '%' END AS pct_text FROM y""",
}
