"""The catalog's queries as DuckDB SQL over the same tables.

Each oracle is a SELECT over shared table expressions; ``_sql`` puts the ones it
needs in front of it.
"""

from __future__ import annotations

import re

from sessionloom.functions.permutations import ROUNDS
from sessionloom.plans import workload as w
from sessionloom.sources.blueprints import BLUEPRINTS, SIMPLE_BLUEPRINT
from sessionloom.sources.signals import SIGNALS

ORACLES: dict[str, str] = {}

_CTES: dict[str, str] = {}


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _values(name: str, columns: str, rows: list[tuple]) -> None:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    _CTES[f"{name}({columns})"] = f"VALUES {body}"


def _node_rows() -> list[tuple]:
    rows = []
    for blueprint, doc in BLUEPRINTS.items():
        for i, node in enumerate(doc["nodes"]):
            p = node["params"]
            rows.append((
                blueprint, i, node["name"], node["batch_type"], p.get("last_n", 0), p.get("n_topics", 0),
                p.get("apply_threshold"), p.get("apply_mmr", False), p.get("mu", 0), p.get("alpha", 0), p.get("r", 0),
            ))
    return rows


_values("vocabulary", "label, weight", SIGNALS)
_values("nodes", "blueprint, node_ord, name, batch_type, last_n, n_topics, threshold, mmr, mu, alpha, r", _node_rows())
_values(
    "edges",
    "blueprint, edge_ord, s, action, t",
    [
        (b, i, e["start"], e["edge_type"], e["end"])
        for b, doc in BLUEPRINTS.items()
        for i, e in enumerate(doc["edges"])
    ],
)

_ACTION = (
    "CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in w.ACTION_OF_EVENT.items())
    + " ELSE upper(event_type) END"
)

_CTES |= {
    "items": "SELECT vec_id AS id, embedding::DOUBLE[] AS e, label FROM embeddings",
    "acts": f"""SELECT user_id AS session_id, ts, event_id AS seq, {_ACTION} AS action,
        regexp_extract(props, '([0-9]+)', 1)::BIGINT AS item_id FROM events""",
    "slog": """SELECT session_id, ts, seq, label, weight::DOUBLE AS weight, item_id
        FROM acts JOIN vocabulary ON action = label""",
    "hist": "SELECT DISTINCT session_id, item_id AS hv FROM slog",
    "latest": """SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts DESC, seq DESC) - 1 AS q_idx
        FROM slog""",
    "profile": """SELECT session_id, q_idx, e, weight, label_i FROM (
        SELECT l.session_id, l.q_idx, i.e, l.weight, i.label AS label_i FROM latest l JOIN items i ON l.item_id = i.id
        WHERE l.q_idx < 50)""",
    "sessions": f"""SELECT DISTINCT user_id AS session_id,
        CASE user_id % {len(w.LABELS)} {" ".join(
            f"WHEN {i} THEN '{SIMPLE_BLUEPRINT if x == 'SIMPLE' else x}'" for i, x in enumerate(w.LABELS)
        )} END AS blueprint FROM events""",
    "start": "SELECT blueprint, name AS first_state FROM nodes WHERE node_ord = 0",
    "numbered": """SELECT a.session_id, a.ts, a.seq, a.action, s.blueprint,
        row_number() OVER (PARTITION BY a.session_id ORDER BY a.ts, a.seq) AS n
        FROM acts a JOIN sessions s USING (session_id)
        WHERE a.action = 'BATCH' OR a.action IN (SELECT label FROM vocabulary)""",
    "step": """SELECT n.blueprint, n.name AS s, n.batch_type, a.action,
        coalesce(arg_min(e.t, e.edge_ord) FILTER (WHERE e.action = a.action),
                 arg_min(e.t, e.edge_ord) FILTER (WHERE e.action = 'DEFAULT')) AS t
        FROM nodes n CROSS JOIN (SELECT label AS action FROM vocabulary UNION SELECT 'BATCH') a
        JOIN edges e ON e.blueprint = n.blueprint AND e.s = n.name
        GROUP BY n.blueprint, n.name, n.batch_type, a.action""",
    "trace": """SELECT x.session_id, x.seq, x.n, x.action, st.s AS state, st.t AS next_state, st.batch_type
        FROM numbered x JOIN start USING (blueprint)
        JOIN step st ON st.blueprint = x.blueprint AND st.s = first_state AND st.action = x.action
        WHERE x.n = 1
        UNION ALL
        SELECT x.session_id, x.seq, x.n, x.action, st.s, st.t, st.batch_type
        FROM trace p JOIN numbered x ON x.session_id = p.session_id AND x.n = p.n + 1
        JOIN step st ON st.blueprint = x.blueprint AND st.s = p.next_state AND st.action = x.action""",
    "asked": """SELECT s.session_id, s.blueprint, f.state AS shown_state, st.batch_type, st.t AS next_state,
        nd.last_n, nd.n_topics, nd.threshold, nd.mmr, nd.mu, nd.alpha, nd.r
        FROM sessions s JOIN start USING (blueprint)
        LEFT JOIN (SELECT session_id, arg_max(next_state, n) AS state FROM trace GROUP BY session_id) f USING (session_id)
        JOIN nodes nd ON nd.blueprint = s.blueprint AND nd.name = coalesce(f.state, first_state)
        JOIN step st ON st.blueprint = s.blueprint AND st.s = nd.name AND st.action = 'BATCH'""",
    "topics": """SELECT row_number() OVER (ORDER BY label) - 1 AS topic, list(m ORDER BY pos) AS e FROM (
        SELECT label, pos, round(avg(x), 9) AS m FROM (
            SELECT label, unnest(e) AS x, unnest(range(len(e))) AS pos FROM items) GROUP BY label, pos) GROUP BY label""",
    "centroid": """SELECT list(m ORDER BY pos) AS c FROM (
        SELECT pos, round(avg(x), 9) AS m FROM (SELECT unnest(e) AS x, unnest(range(len(e))) AS pos FROM items)
        GROUP BY pos)""",
    "latest3": "SELECT session_id, q_idx, e, 8 AS top_k FROM profile",
}


def _in_node(blueprint: str, node: str) -> str:
    """Requests of all sessions, as if all were in one node."""
    return f"""SELECT s.session_id, nd.batch_type, nd.last_n, nd.n_topics, nd.threshold, nd.mmr, nd.mu, nd.alpha, nd.r
        FROM (SELECT DISTINCT session_id FROM sessions) s CROSS JOIN nodes nd
        WHERE nd.blueprint = '{blueprint}' AND nd.name = '{node}'"""


_METRICS = {
    "cosine_sim": ("list_cosine_similarity", "DESC"),
    "euclidean_dist": ("list_distance", "ASC"),
    "dot_product": ("list_dot_product", "DESC"),
}


def _knn(queries: str, carried: str = "", items: str = "items", metric: str = "cosine_sim", exclude: str | None = None) -> str:
    fn, order = _METRICS[metric]
    where = ""
    if exclude:
        where = f"WHERE NOT EXISTS (SELECT 1 FROM {exclude} h WHERE h.session_id = q.session_id AND h.hv = i.id)"
    return f"""SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY session_id, q_idx ORDER BY score {order}, id) AS rank FROM (
            SELECT q.session_id, q.q_idx, q.top_k{carried}, i.id, round({fn}(q.e, i.e), 9) AS score
            FROM {queries} q CROSS JOIN {items} i {where}))
        WHERE rank <= top_k"""


_CTES["found"] = _knn("latest3")


def _uniform(seed, session: str, q: str) -> str:
    """64 numbers from md5, scaled to a unit vector: a scalar subquery."""
    word = "(('0x' || substr(md5('%s' || ':' || %s || ':' || %s || ':' || (i // 4)), 8 * (i %% 4) + 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
    return word % (seed, session, q)


def _random_vectors(name: str, requests: str, n: int, seed: int) -> None:
    """Table ``name(session_id, q_idx, e)`` of n random unit vectors per request."""
    _CTES[f"{name}_x"] = f"""SELECT session_id, q_idx, i, {_uniform(seed, 'session_id', 'q_idx')} AS x
        FROM {requests}, (SELECT unnest(range({n})) AS q_idx), (SELECT unnest(range({w.DIM})) AS i)"""
    _CTES[name] = f"""SELECT session_id, q_idx, list(x / (norm + 2.220446049250313e-16) ORDER BY i) AS e FROM (
        SELECT *, sqrt(sum(x * x) OVER (PARTITION BY session_id, q_idx)) AS norm FROM {name}_x)
        GROUP BY session_id, q_idx"""


def _budgets(name: str, weighted: str, requests: str, batch: int = 10) -> None:
    """Queries with budgets and parameters out of ``weighted(session_id, q_idx, e, weight)``."""
    _CTES[name] = f"""SELECT session_id, q_idx, e, threshold, mmr, true AS dedup,
        CASE WHEN mmr THEN 2 * k ELSE k END AS top_k, CASE WHEN mmr THEN k ELSE 1 END AS top_k_mmr FROM (
        SELECT b.*, r.threshold, r.mmr, greatest(budget, 5)::INT AS k FROM ({_budget(weighted, batch)}) b
        JOIN {requests} r USING (session_id))"""


def _budget(weighted: str, batch: int) -> str:
    c = max(batch * 0.15, 1)
    return f"""SELECT * EXCLUDE (lw, total, least_w), (CASE WHEN total BETWEEN {batch - c} AND {batch + c} THEN floor(lw)
        ELSE ceil(lw * ({float(batch)}::DOUBLE / total)) END)::INT AS budget FROM (
        SELECT *, sum(lw) OVER (PARTITION BY session_id) AS total FROM (
            SELECT *, CASE WHEN least_w < 1 THEN weight + (1 - least_w) ELSE weight END AS lw FROM (
                SELECT *, min(weight) OVER (PARTITION BY session_id) AS least_w FROM {weighted})))"""


def _threshold(source: str, threshold: str = "threshold", metric: str = "cosine_sim") -> str:
    query = "OVER (PARTITION BY session_id, q_idx)"
    if metric == "euclidean_dist":
        passes = f"score <= greatest({threshold}, round(avg(score) {query}, 9), min(score) {query})"
    else:
        passes = f"score >= least({threshold}, round(avg(score) {query}, 9), max(score) {query})"
    return f"SELECT * FROM {source} QUALIFY {threshold} IS NULL OR {passes}"


MMR_STEPS = 12


def _mmr(name: str, source: str, seed_order: str = "ASC", steps: int = MMR_STEPS) -> None:
    """Table ``name``: the rows of ``source`` MMR picks, ``rank`` = pick order.

    One table per greedy step: what is left, its redundancy and the order of choice.
    """
    _CTES[f"{name}_1"] = f"""SELECT s.*, i.e AS ie, -2.0::DOUBLE AS red,
        row_number() OVER (PARTITION BY session_id, q_idx ORDER BY score {seed_order}, rank) AS choice
        FROM {source} s JOIN items i USING (id)"""
    for t in range(2, steps + 1):
        _CTES[f"{name}_{t}"] = f"""SELECT * REPLACE (row_number() OVER (PARTITION BY session_id, q_idx
                ORDER BY round(0.5::DOUBLE * score - 0.5::DOUBLE * red, 9) DESC, rank) AS choice) FROM (
            SELECT r.* REPLACE (greatest(r.red, round(list_cosine_similarity(r.ie, p.ie), 9)) AS red)
            FROM {name}_{t - 1} r JOIN {name}_{t - 1} p
            ON r.session_id = p.session_id AND r.q_idx = p.q_idx AND p.choice = 1 WHERE r.choice > 1)"""
    _CTES[name] = " UNION ALL ".join(
        f"SELECT * EXCLUDE (ie, red, choice) REPLACE ({t} AS rank) FROM {name}_{t} WHERE choice = 1 AND {t} <= top_k_mmr"
        for t in range(1, steps + 1)
    )


def _dedup(source: str, optional: bool = False) -> str:
    condition = "row_number() OVER (PARTITION BY session_id, id ORDER BY q_idx, rank) = 1"
    return f"SELECT * FROM {source} QUALIFY {condition}" + (" OR NOT dedup" if optional else "")


def _rerank(source: str) -> str:
    rank = "row_number() OVER (PARTITION BY session_id, q_idx ORDER BY score DESC, rank)"
    return f"SELECT * REPLACE ({rank} AS rank) FROM {source}"


def _shuffle(source: str, seed: int) -> str:
    draw = f"md5('{seed}' || ':' || session_id || ':' || id)"
    return f"SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY {draw}, q_idx) AS position FROM {source}"


def _chain(name: str, candidates: str, seed: int = 0) -> None:
    """Table ``name``: the post-search chain over ``candidates``."""
    _CTES[f"{name}_thr"] = _threshold(candidates)
    _CTES[f"{name}_div"] = f"SELECT * FROM {name}_thr WHERE mmr"
    _mmr(f"{name}_mmr", f"{name}_div")
    _CTES[f"{name}_all"] = f"SELECT * FROM {name}_thr WHERE NOT mmr UNION ALL BY NAME SELECT * FROM {name}_mmr"
    _CTES[f"{name}_uniq"] = _dedup(f"{name}_all", optional=True)
    _CTES[f"{name}_rank"] = f"SELECT * FROM ({_rerank(f'{name}_uniq')}) WHERE rank <= top_k"
    _CTES[name] = _shuffle(f"{name}_rank", seed)


def _batch(name: str, queries: str, exclude: str | None, size: int = 10) -> str:
    """The served batch of a table of budgeted queries."""
    _CTES[f"{name}_cand"] = _knn(queries, ", q.threshold, q.mmr, q.dedup, q.top_k_mmr", exclude=exclude)
    _chain(f"{name}_pool", f"{name}_cand")
    return f"SELECT session_id, position, id, round(score, 6) AS score FROM {name}_pool WHERE position <= {size}"


def _sql(select: str) -> str:
    """``select`` with the table expressions it needs, in order of definition."""
    bodies = {re.match(r"\w+", k).group(): (k, v) for k, v in _CTES.items()}
    order: list[str] = []

    def need(text: str, open_names: tuple = ()) -> None:
        for word in dict.fromkeys(re.findall(r"\b\w+\b", text)):
            if word in bodies and word not in order and word not in open_names:
                need(bodies[word][1], (*open_names, word))
                order.append(word)

    need(select)
    parts = [f"{bodies[n][0]} AS {'' if n.endswith('trace') else 'MATERIALIZED '}({bodies[n][1]})" for n in order]
    return f"WITH RECURSIVE {', '.join(parts)} {select}" if parts else select


def _oracle(name: str, select: str) -> None:
    ORACLES[name] = _sql(select)


def _shown(source: str, more: str = "") -> str:
    return f"SELECT session_id, q_idx, rank, id, round(score, 6) AS score{more} FROM {source}"


def _checksum(vector: str) -> str:
    scaled = f"list_transform({vector}, lambda x, i: i * round(x * 1e6)::BIGINT)"
    return f"list_sum({scaled})::BIGINT AS checksum"


def _ends(source: str) -> str:
    return f"""SELECT session_id, q_idx, round(weight, 6) AS weight, round(e[1], 6) AS first_x,
        round(e[{w.DIM}], 6) AS last_x, {_checksum("e")} FROM {source}"""


# --- sources ---------------------------------------------------------------

_oracle("load_items", "SELECT id, label, len(e) AS dim FROM items")
_oracle(
    "load_signals",
    """SELECT label, weight::DOUBLE AS weight FROM vocabulary WHERE label NOT IN (SELECT upper(event_type) FROM events)
    UNION ALL SELECT upper(event_type), arg_max(value, (ts, event_id)) FROM events GROUP BY 1""",
)

_TYPE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in w.BATCH_TYPE_OF_EVENT.items()) + " END"
_CTES["custom"] = f"""SELECT user_id::VARCHAR AS blueprint, event_type AS name, count(*)::INT AS n, {_TYPE} AS batch_type,
    row_number() OVER (PARTITION BY user_id ORDER BY event_type) - 1 AS node_ord,
    count(*) OVER (PARTITION BY user_id) AS n_nodes,
    first(event_type) OVER (PARTITION BY user_id ORDER BY event_type) AS first_name,
    coalesce(lead(event_type) OVER (PARTITION BY user_id ORDER BY event_type),
             first(event_type) OVER (PARTITION BY user_id ORDER BY event_type)) AS next_name
    FROM events GROUP BY user_id, event_type"""
_CTES["custom_edges"] = """SELECT blueprint,
    row_number() OVER (PARTITION BY blueprint ORDER BY kind, s) - 1 AS edge_ord, s, action, t FROM (
        SELECT blueprint, 0 AS kind, name AS s, 'PURCHASE' AS action, name AS t FROM custom WHERE n % 2 = 0
        UNION ALL SELECT blueprint, 1, name, 'DEFAULT', first_name FROM custom WHERE n % 11 <> 0
        UNION ALL SELECT blueprint, 2, name, 'BATCH', next_name FROM custom WHERE n % 10 <> 0)"""
_oracle("load_blueprints", "SELECT blueprint, node_ord, name, batch_type FROM custom")
_oracle("load_blueprint_edges", 'SELECT blueprint, edge_ord, s AS "start", action, t AS target FROM custom_edges')
_oracle(
    "normalise_params",
    """SELECT blueprint, name, n / 100.0::DOUBLE AS mu, 0.0::DOUBLE AS alpha, 0.0::DOUBLE AS r, n AS last_n, 0 AS n_topics,
    true AS remove_duplicates,
    CASE WHEN n % 2 = 0 OR n % 3 = 0 THEN n / 100.0::DOUBLE END AS threshold,
    n % 3 = 0 OR n % 4 = 0 AS apply_mmr, CASE WHEN n % 13 = 0 THEN 1 ELSE 0 END AS n_unknown FROM custom""",
)
_oracle(
    "validate_blueprints",
    """SELECT blueprint, name AS subject, 'no BATCH edge' AS problem FROM custom WHERE n % 10 = 0
    UNION ALL SELECT blueprint, name, 'signals not covered' FROM custom WHERE n % 11 = 0
    UNION ALL SELECT blueprint, name, 'unknown parameter' FROM custom WHERE n % 13 = 0""",
)
_oracle(
    "create_sessions",
    f"""SELECT session_id, CASE WHEN label IN ('SIMPLE', 'CUSTOM') THEN label ELSE 'FACTORY' END AS algorithm,
    CASE WHEN label NOT IN ('SIMPLE', 'CUSTOM') THEN label END AS factory_id,
    CASE WHEN label = 'CUSTOM' THEN 'bp-' || session_id END AS custom_id, 'embeddings' AS collection, '0' AS state,
    false AS has_embeddings, session_id % 2 = 0 AS is_persistent FROM (
        SELECT DISTINCT user_id AS session_id, [{", ".join(f"'{x}'" for x in [*w.LABELS, "CUSTOM"])}][user_id % 7 + 1] AS label
        FROM events)""",
)
_oracle(
    "route_algorithm",
    f"""SELECT session_id, CASE WHEN label IN ('SIMPLE', 'CUSTOM') THEN label ELSE 'FACTORY' END AS algorithm,
    CASE label WHEN 'SIMPLE' THEN '{SIMPLE_BLUEPRINT}' WHEN 'CUSTOM' THEN 'bp-' || session_id ELSE label END AS blueprint
    FROM (SELECT DISTINCT user_id AS session_id, [{", ".join(f"'{x}'" for x in [*w.LABELS, "CUSTOM"])}][user_id % 7 + 1] AS label
        FROM events)""",
)
_oracle(
    "temporary_sessions",
    """SELECT user_id, session_no, min(ts) AS started, max(ts) AS ended, count(*) AS n_events FROM (
        SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session_no FROM (
            SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events))
    GROUP BY user_id, session_no""",
)
_oracle(
    "append_history",
    """SELECT session_id, CASE WHEN day(ts) <= 15 THEN 0 ELSE 1 END AS batch_id, count(*) AS n
    FROM slog GROUP BY ALL""",
)
_oracle("read_history", "SELECT DISTINCT session_id, item_id AS history_value FROM slog WHERE day(ts) % 2 = 0")

# --- projections, filters --------------------------------------------------

_CTES["popular"] = "SELECT item_id FROM slog GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 1"
_oracle("fetch", f"SELECT id, label, {_checksum('e')} FROM items WHERE id = (SELECT item_id FROM popular)")
_oracle("multi_fetch", "SELECT id, label FROM items JOIN customer ON id = c_custkey")
_oracle("missing_ids", "SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT id FROM items)")
_oracle(
    "history_filter",
    """SELECT session_id, item_id AS history_value, seq FROM acts a WHERE action = 'ERROR' AND NOT EXISTS (
        SELECT 1 FROM hist h WHERE h.session_id = a.session_id AND h.hv = a.item_id)""",
)
_oracle("history_search", _shown(f"({_knn('latest3', exclude='hist')})"))
_CTES["even_items"] = "SELECT * FROM items WHERE label % 2 = 0"
_oracle("history_prior_filter", _shown(f"({_knn('latest3', items='even_items', exclude='hist')})"))
_oracle(
    "history_by_field",
    """SELECT session_id, q_idx, rank, id, round(score, 6) AS score FROM (
        SELECT q.session_id, q.q_idx, i.id, round(list_cosine_similarity(q.e, i.e), 9) AS score,
            row_number() OVER (PARTITION BY q.session_id, q.q_idx ORDER BY score DESC, i.id) AS rank
        FROM latest3 q CROSS JOIN items i WHERE NOT EXISTS (
            SELECT 1 FROM profile p WHERE p.q_idx < 3 AND p.session_id = q.session_id AND p.label_i = i.label))
    WHERE rank <= 8""",
)
_oracle("result_projection", _shown("found JOIN items USING (id)", ", label"))
_oracle("apply_threshold", _shown(f"({_threshold('found', '0.33::DOUBLE')})"))
_CTES["found_far"] = _knn("latest3", metric="euclidean_dist")
_oracle("apply_threshold_euclidean", _shown(f"({_threshold('found_far', '1.1::DOUBLE', 'euclidean_dist')})"))
_oracle(
    "remove_ids",
    _shown("found f")
    + """ WHERE NOT EXISTS (SELECT 1 FROM slog s
        WHERE s.label = 'PURCHASE' AND s.session_id = f.session_id AND s.item_id = f.id)""",
)
_oracle(
    "parse_action",
    """SELECT seq, action, v.weight::DOUBLE AS weight, action = 'BATCH' AS is_batch,
    action = 'BATCH' OR v.label IS NOT NULL AS known FROM acts LEFT JOIN vocabulary v ON action = v.label""",
)
_oracle(
    "signal_guard",
    "SELECT session_id, seq, action FROM acts WHERE action NOT IN (SELECT label FROM vocabulary)",
)

# --- joins -----------------------------------------------------------------

_oracle(
    "search",
    """SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, round(score, 6) AS score FROM (
        SELECT i.id, round(list_cosine_similarity(q.e, i.e), 9) AS score
        FROM items i, items q WHERE q.id = (SELECT item_id FROM popular) ORDER BY score DESC, i.id LIMIT 10)""",
)
_CTES["item_queries"] = "SELECT id AS session_id, 0 AS q_idx, e, 10 AS top_k FROM items"
for _name, _metric in (
    ("multi_search", "cosine_sim"),
    ("multi_search_euclidean", "euclidean_dist"),
    ("multi_search_dot", "dot_product"),
):
    _oracle(_name, _shown(f"({_knn('item_queries', metric=_metric)})"))
ORACLES["indexed_search"] = ORACLES["multi_search"]
ORACLES["stored_index_search"] = ORACLES["multi_search"]
ORACLES["indexed_history_search"] = ORACLES["history_search"]
_oracle(
    "signal_item_join",
    """SELECT session_id, seq, s.label, weight, item_id, item_id AS history_value, list_sum(list_transform(e, lambda x, i: i * round(x * 1e6)::BIGINT))::BIGINT AS checksum
    FROM slog s JOIN items i ON item_id = i.id""",
)
_oracle(
    "transition_lookup",
    """SELECT x.session_id, x.seq, st.t AS next_state, st.batch_type, nd.last_n, nd.threshold::DOUBLE AS threshold
    FROM numbered x JOIN start USING (blueprint)
    JOIN step st ON st.blueprint = x.blueprint AND st.s = first_state AND st.action = x.action
    JOIN nodes nd ON nd.blueprint = x.blueprint AND nd.name = first_state""",
)

# --- aggregations ----------------------------------------------------------

_oracle("user_embeddings", _ends("profile"))
_oracle(
    "has_embeddings",
    """SELECT session_id, seq, coalesce(max((action <> 'BATCH')::INT) OVER (PARTITION BY session_id ORDER BY n
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS has_embeddings FROM numbered""",
)


def _own(requests: str) -> str:
    """Profile rows a request's node looks at."""
    return f"""SELECT p.session_id, p.q_idx, p.e, p.weight FROM profile p JOIN {requests} r USING (session_id)
        WHERE p.q_idx < CASE WHEN r.last_n > 0 THEN r.last_n ELSE 50 END"""


def _spread(name: str, requests: str) -> None:
    """Table ``name``: the profile under the policy ``spread``."""
    _CTES[f"{name}_x"] = f"""SELECT p.session_id, p.q_idx, i, round(power(p.weight, 1 - r.alpha), 9) AS weight,
        (1 - r.mu) * p.e[i + 1] + r.mu * c.c[i + 1] AS x
        FROM profile p JOIN {requests} r USING (session_id), centroid c, (SELECT unnest(range({w.DIM})) AS i)
        WHERE p.q_idx < CASE WHEN r.last_n > 0 THEN r.last_n ELSE 50 END"""
    _CTES[f"{name}_own"] = f"""SELECT session_id, q_idx, list(x / (norm + 2.220446049250313e-16) ORDER BY i) AS e,
        any_value(weight) AS weight FROM (
            SELECT *, sqrt(sum(x * x) OVER (PARTITION BY session_id, q_idx)) AS norm FROM {name}_x)
        GROUP BY session_id, q_idx"""
    _CTES[f"{name}_sum"] = f"""SELECT session_id, max(q_idx) AS last, avg(weight) AS weight,
        ceil(any_value(r.r) * count(*))::INT AS extra FROM {name}_own JOIN {requests} r USING (session_id)
        GROUP BY session_id"""
    _CTES[f"{name}_add"] = f"""SELECT session_id, q_idx, i, weight, {_uniform(0, 'session_id', 'q_idx')} AS x FROM (
        SELECT session_id, weight, last + unnest(range(extra)) + 1 AS q_idx FROM {name}_sum),
        (SELECT unnest(range({w.DIM})) AS i)"""
    _CTES[name] = f"""SELECT session_id, q_idx, e, weight FROM {name}_own UNION ALL
        SELECT session_id, q_idx, list(x / (norm + 2.220446049250313e-16) ORDER BY i), any_value(weight) FROM (
            SELECT *, sqrt(sum(x * x) OVER (PARTITION BY session_id, q_idx)) AS norm FROM {name}_add)
        GROUP BY session_id, q_idx"""


def _with_bias(own: str, requests: str, session: str = "r.session_id") -> str:
    return f"""SELECT session_id, q_idx, e, weight FROM {own} UNION ALL
        SELECT r.session_id, coalesce(b.n, 0) + t.topic // 2, t.e, 1.0::DOUBLE
        FROM {requests} r JOIN topics t ON t.topic % 2 = {session} % 2
        LEFT JOIN (SELECT session_id, max(q_idx) + 1 AS n FROM {own} GROUP BY session_id) b USING (session_id)"""


def _drawn(requests: str, seed: int = 0) -> str:
    """The first ``n_topics`` places of each session's permutation, one round after the other."""
    places = f"""SELECT session_id, unnest(range(least(n_topics, n)::INT)) AS q_idx, n, q_idx AS place
        FROM {requests}, (SELECT count(*) AS n FROM topics)"""
    for k in range(ROUNDS):
        key = f"'{seed}:' || session_id || ':{k}'"
        mirrored = f"SELECT *, (('0x' || substr(md5({key}), 1, 8))::BIGINT % n + n - place) % n AS mirror FROM ({places})"
        places = f"""SELECT session_id, q_idx, n,
            CASE WHEN substr(md5({key} || ':' || greatest(place, mirror)), 1, 1) >= '8' THEN mirror ELSE place END AS place
            FROM ({mirrored})"""
    return f"SELECT session_id, q_idx, e, 1.0::DOUBLE AS weight FROM ({places}) JOIN topics ON topic = place"


_CTES["ask_personal"] = "SELECT * FROM asked WHERE batch_type = 'personalized'"
_CTES["in_journey"] = _in_node("UNIQUE_JOURNEYS", "Exploration")
_CTES["in_welcome"] = _in_node("UNIQUE_JOURNEYS", "Welcome")
_CTES["in_curated"] = _in_node(SIMPLE_BLUEPRINT, "Curated")
_CTES["in_simple"] = _in_node(SIMPLE_BLUEPRINT, "Exploration")
_CTES["in_browsing"] = _in_node("NAVIGABLE_UX", "Browsing")
_CTES["in_chance"] = _in_node("NAVIGABLE_UX", "Exploration")
_CTES["in_focus"] = _in_node("UNIQUE_JOURNEYS", "Focus")
_CTES["own_welcome"] = _own("in_welcome")
_spread("journey", "in_journey")
_oracle("personalized_profile", _ends(f"({_own('ask_personal')})"))
_oracle("personalized_profile_spread", _ends("journey"))
_oracle("biased_profile", _ends(f"({_with_bias('own_welcome', 'in_welcome')})"))
_oracle("sampled_profile", _ends(f"({_drawn('in_simple')})"))
_CTES["latest5"] = "SELECT session_id, q_idx, weight FROM latest WHERE q_idx < 5"
_oracle("adjust_weights", f"SELECT session_id, q_idx, weight, budget FROM ({_budget('latest5', 10)})")
_CTES["latest7"] = "SELECT session_id, q_idx, seq, (weight - 6) / 4 AS weight FROM latest WHERE q_idx < 7"
_oracle(
    "adjust_fractional_weights",
    f"""SELECT session_id, q_idx, budget, CASE WHEN seq % 2 = 0 THEN 2 * k ELSE k END AS top_k,
    CASE WHEN seq % 2 = 0 THEN k ELSE 1 END AS top_k_mmr FROM (
        SELECT *, greatest(budget, 5)::INT AS k FROM ({_budget('latest7', 20)}))""",
)
_oracle("non_unique_ids", "SELECT id, count(*) AS occurrences FROM found GROUP BY id HAVING count(*) > 1")

_CTES["one_request"] = "SELECT 0 AS session_id"
_random_vectors("probes", "one_request", 20, 3)
_CTES["probe_queries"] = "SELECT *, 5 AS top_k FROM probes"
_CTES["sample"] = f"SELECT s.q_idx, s.rank, s.id, i.e FROM ({_knn('probe_queries')}) s JOIN items i USING (id)"
_oracle("training_sample", "SELECT q_idx, rank, id FROM sample")


def _cuts(source: str) -> str:
    return f"""SELECT unnest(c) AS cut, unnest(range(256)) AS level FROM (
        SELECT quantile_cont(x, [{", ".join(str(i / 256) for i in range(256))}]) AS c
        FROM (SELECT unnest(e) AS x FROM {source}))"""


def _codes(source: str, cuts: str) -> str:
    """Long form: one row per component."""
    return f"""SELECT s.*, pos, x, least((SELECT count(*) FROM {cuts} WHERE cut <= x), 255) AS code
        FROM (SELECT * EXCLUDE e, unnest(e) AS x, unnest(range(len(e))) AS pos FROM {source}) s"""


_CTES["item_cuts"] = _cuts("items")
_CTES["item_codes"] = _codes("items", "item_cuts")
_CTES["item_decoded"] = "SELECT id, pos, x, cut FROM item_codes JOIN item_cuts ON code = level"
_CTES["sample_cuts"] = _cuts("sample")
_CTES["sample_codes"] = _codes("sample", "sample_cuts")
_oracle("sketch_rank_error", "SELECT unnest(range(256)) AS level, true AS close")
_oracle("train_scalar_quantizer", "SELECT level, round(cut, 9) AS cut FROM item_cuts")

# --- windows, sorts, set operations ----------------------------------------

_CTES["found_thr"] = _threshold("found", "0.33::DOUBLE")
_oracle("rank_candidates", _shown(f"({_rerank('found_thr')})"))
_CTES["found_uniq"] = _dedup("found")
_oracle("remove_duplicates", _shown("found_uniq"))
_oracle(
    "session_state_trace", "SELECT session_id, seq, action, state, next_state, batch_type FROM trace"
)
_CTES["custom_step"] = """SELECT c.blueprint, c.name AS s, a.action,
    coalesce(arg_min(e.t, e.edge_ord) FILTER (WHERE e.action = a.action),
             arg_min(e.t, e.edge_ord) FILTER (WHERE e.action = 'DEFAULT'), c.name) AS t
    FROM custom c CROSS JOIN (SELECT DISTINCT action FROM numbered) a
    LEFT JOIN custom_edges e ON e.blueprint = c.blueprint AND e.s = c.name
    GROUP BY c.blueprint, c.name, a.action"""
_CTES["custom_trace"] = """SELECT x.session_id, x.seq, x.n, x.action, st.s AS state, st.t AS next_state
    FROM numbered x JOIN custom_step st ON st.blueprint = x.session_id::VARCHAR AND st.action = x.action
    JOIN custom c ON c.blueprint = st.blueprint AND c.name = st.s AND c.node_ord = 0
    WHERE x.n = 1
    UNION ALL
    SELECT x.session_id, x.seq, x.n, x.action, st.s, st.t
    FROM custom_trace p JOIN numbered x ON x.session_id = p.session_id AND x.n = p.n + 1
    JOIN custom_step st ON st.blueprint = x.session_id::VARCHAR AND st.s = p.next_state AND st.action = x.action"""
_oracle("custom_state_trace", "SELECT session_id, seq, action, state, next_state FROM custom_trace")
_CTES["custom_acts"] = """SELECT a.session_id, a.ts, a.seq, a.item_id,
    CASE WHEN a.action = 'ERROR' THEN 'USER_SIGNAL' ELSE a.action END AS action,
    CASE WHEN a.action = 'ERROR' THEN 1.5 ELSE v.weight END::DOUBLE AS weight,
    row_number() OVER (PARTITION BY a.session_id ORDER BY a.ts, a.seq) AS n
    FROM acts a LEFT JOIN vocabulary v ON a.action = v.label"""
_oracle("custom_signals", "SELECT session_id, seq, action, weight, weight IS NOT NULL OR action = 'BATCH' AS known FROM custom_acts")
_CTES["signal_step"] = _CTES["custom_step"].replace("FROM numbered)", "FROM custom_acts)")
_CTES["signal_trace"] = (
    _CTES["custom_trace"]
    .replace("numbered x", "custom_acts x")
    .replace("custom_step", "signal_step")
    .replace("FROM custom_trace p", "FROM signal_trace p")
)
_oracle("custom_signal_trace", "SELECT session_id, seq, action, state, next_state FROM signal_trace")
_CTES["signal_profile"] = """SELECT session_id, q_idx, e, weight FROM (
    SELECT a.session_id, a.weight, i.e,
        row_number() OVER (PARTITION BY a.session_id ORDER BY a.ts DESC, a.seq DESC) - 1 AS q_idx
    FROM custom_acts a JOIN items i ON a.item_id = i.id WHERE a.action <> 'BATCH') WHERE q_idx < 50"""
_oracle("custom_signal_profile", _ends("signal_profile"))
_CTES["found4"] = "SELECT *, 4 AS top_k_mmr FROM found"
_mmr("diverse", "found4", steps=4)
_mmr("diverse_top", "found4", "DESC", steps=4)
_oracle("maximal_marginal_relevance", _shown("diverse"))
_oracle("maximal_marginal_relevance_most_similar", _shown("diverse_top"))
_oracle("truncate_per_query", _shown(f"({_rerank('found_uniq')}) WHERE rank <= 3"))
_CTES["found_pool"] = _shuffle("found_uniq", 5)
_oracle("shuffle_pool", "SELECT session_id, position, id, round(score, 6) AS score FROM found_pool")
_oracle("take_batch", "SELECT session_id, position, id, round(score, 6) AS score FROM found_pool WHERE position <= 10")
_CTES["latest5e"] = "SELECT session_id, q_idx, e, 4 AS top_k FROM profile"
_CTES["found5"] = _knn("latest5e")
_oracle(
    "concat_results",
    _shown("found5", ", row_number() OVER (PARTITION BY session_id ORDER BY q_idx, rank) AS position"),
)
_oracle("concat_queries", _ends("profile"))

# --- scalar and vector functions -------------------------------------------

_CTES["pairs"] = "SELECT a.id AS a, b.id AS b, a.e AS va, b.e AS vb FROM items a JOIN items b ON b.id = a.id + 1"
_oracle(
    "vector_similarity",
    """SELECT a, b, round(list_dot_product(va, vb), 6) AS dot, round(list_cosine_similarity(va, vb), 6) AS cosine,
    round(list_distance(va, vb), 6) AS euclidean, round(sqrt(list_dot_product(va, va)), 6) AS norm FROM pairs""",
)
_oracle("vector_concat", f"SELECT a || '_' || b AS id, len(va || vb) AS dim, round((va || vb)[{w.DIM + 1}], 6) AS x FROM pairs")
_random_vectors("chance1", "sessions", 10, 1)
_oracle("random_queries", _ends("(SELECT *, 1.0::DOUBLE AS weight FROM chance1)"))
_oracle("quantize_scalar", "SELECT id, string_agg(code, ',' ORDER BY pos) AS codes FROM item_codes GROUP BY id")
_oracle("dequantize_scalar", "SELECT id, pos, round(cut, 6) AS x FROM item_decoded")
_oracle(
    "reconstruction_error",
    """SELECT count(*) AS vectors, round(avg(l1), 6) AS mean_l1, round(max(l1), 6) AS max_l1 FROM (
        SELECT id, sum(abs(x - cut)) AS l1 FROM item_decoded GROUP BY id)""",
)
_oracle(
    "sketch_collection",
    "SELECT q_idx, rank, id, string_agg(code, ',' ORDER BY pos) AS codes FROM sample_codes GROUP BY q_idx, rank, id",
)

# --- batches ---------------------------------------------------------------

_random_vectors("chance0", "in_chance", 10, 0)


def _chance(vectors: str) -> str:
    return f"""SELECT session_id, q_idx, e, NULL::DOUBLE AS threshold, false AS mmr, true AS dedup,
        10 AS top_k, 5 AS top_k_mmr FROM {vectors}"""


_CTES["chance0_q"] = _chance("chance0")
_oracle("random_batch", _batch("rnd", "chance0_q", None))

_CTES["own_curated"] = _own("in_curated")
_budgets("curated_q", "own_curated", "in_curated")
_CTES["curated_cold"] = "SELECT session_id FROM in_curated WHERE session_id NOT IN (SELECT session_id FROM profile)"
_random_vectors("curated_r", "curated_cold", 10, 0)
_CTES["curated_all"] = f"SELECT * FROM curated_q UNION ALL BY NAME {_chance('curated_r')}"
_oracle("personalized_batch", _batch("cur", "curated_all", "hist"))

_spread("focus", "in_focus")
_budgets("focus_q", "focus", "in_focus")
_oracle("personalized_batch_spread", _batch("foc", "focus_q", "hist"))

_CTES["welcome_w"] = _with_bias("own_welcome", "in_welcome")
_budgets("welcome_q", "welcome_w", "in_welcome")
_oracle("biased_batch", _batch("wel", "welcome_q", "hist"))

_CTES["browsing_w"] = _drawn("in_browsing")
_budgets("browsing_q", "browsing_w", "in_browsing")
_oracle("sampled_batch", _batch("bro", "browsing_q", "hist"))

_CTES["ask_biased"] = "SELECT * FROM asked WHERE batch_type = 'biased'"
_CTES["ask_sampled"] = "SELECT * FROM asked WHERE batch_type = 'sampled'"
_CTES["ask_chance"] = """SELECT * FROM asked WHERE batch_type = 'random'
    OR (batch_type = 'personalized' AND session_id NOT IN (SELECT session_id FROM profile))"""
_CTES["next_own"] = _own("ask_personal")
_CTES["next_biased_own"] = _own("ask_biased")
_CTES["next_biased_w"] = _with_bias("next_biased_own", "ask_biased")
_CTES["next_drawn"] = _drawn("ask_sampled")
_budgets("next_own_q", "next_own", "ask_personal")
_budgets("next_biased_q", "next_biased_w", "ask_biased")
_budgets("next_drawn_q", "next_drawn", "ask_sampled")
_random_vectors("next_r", "ask_chance", 10, 0)
_CTES["next_q"] = f"""SELECT * FROM next_own_q UNION ALL BY NAME SELECT * FROM next_biased_q
    UNION ALL BY NAME SELECT * FROM next_drawn_q UNION ALL BY NAME {_chance('next_r')}"""
_CTES["next_hist"] = "SELECT * FROM hist WHERE session_id NOT IN (SELECT session_id FROM ask_chance)"
_oracle("next_batch", _batch("nxt", "next_q", "next_hist"))
ORACLES["next_batch_indexed"] = ORACLES["next_batch"]

# A second batch: every table of the first one again, after the first one.
_CTES["first_batch"] = "SELECT session_id, id FROM nxt_pool WHERE position <= 10"
_CTES["asked2"] = """SELECT s.session_id, s.blueprint, s.next_state AS shown_state, st.batch_type, st.t AS next_state,
    nd.last_n, nd.n_topics, nd.threshold, nd.mmr, nd.mu, nd.alpha, nd.r
    FROM asked s JOIN nodes nd ON nd.blueprint = s.blueprint AND nd.name = s.next_state
    JOIN step st ON st.blueprint = s.blueprint AND st.s = nd.name AND st.action = 'BATCH'"""
_CTES["hist2"] = "SELECT session_id, hv FROM hist UNION SELECT session_id, id FROM first_batch"
_FIRST = [k for k in _CTES if re.match(r"(ask_|next_)", k)]
_SECOND = re.compile(r"\b(" + "|".join(["asked", "hist", *_FIRST]) + r")\b")
for _name in _FIRST:
    _CTES[f"{_name}2"] = _SECOND.sub(r"\g<1>2", _CTES[_name])
_TWICE = _batch("nxt2", "next_q2", "next_hist2")
_oracle(
    "next_batch_twice",
    f"SELECT t.session_id, t.position, t.id, t.score, i.label FROM ({_TWICE}) t JOIN items i ON t.id = i.id",
)
_oracle(
    "next_batch_requests",
    "SELECT session_id, blueprint, coalesce(shown_state, '0') AS state, batch_type, next_state FROM asked",
)
_CTES["chain_in"] = """SELECT *, 0.3::DOUBLE AS threshold, session_id % 2 = 0 AS mmr, session_id % 3 <> 0 AS dedup,
    4 AS top_k_mmr FROM found"""
_chain("chain", "chain_in", 2)
_oracle("apply_params", "SELECT session_id, q_idx, rank, position, id, round(score, 6) AS score FROM chain")

_CTES["faulty"] = """SELECT a.session_id, a.ts, a.seq, a.action, s.blueprint AS bp, a.session_id % 7 = 2 AS lost,
    CASE WHEN a.action <> 'BATCH' AND a.action NOT IN (SELECT label FROM vocabulary) THEN 'unknown action'
        WHEN a.session_id % 17 = 3 THEN 'unknown session'
        WHEN a.session_id % 11 = 5 THEN 'no blueprint'
        WHEN a.session_id % 7 = 2 THEN 'unknown state'
        WHEN a.action <> 'BATCH' AND a.item_id * (a.seq % 13 + 1) NOT IN (SELECT id FROM items) THEN 'unknown item' END AS reason
    FROM acts a JOIN sessions s USING (session_id)"""
_oracle("rejected_actions", "SELECT session_id, seq, reason FROM faulty WHERE reason IS NOT NULL")
_CTES["sound"] = """SELECT session_id, seq, action, bp AS blueprint,
    row_number() OVER (PARTITION BY session_id ORDER BY ts, seq) AS n FROM faulty WHERE reason IS NULL"""
_CTES["sound_trace"] = _CTES["trace"].replace("numbered x", "sound x").replace("FROM trace p", "FROM sound_trace p")
_oracle("accepted_state_trace", "SELECT session_id, seq, action, state, next_state, batch_type FROM sound_trace")

# --- streaming -------------------------------------------------------------

_oracle("dedup_signals", "SELECT session_id, seq, action FROM numbered")
ORACLES["dedup_watermark"] = ORACLES["dedup_signals"]
_CTES["arriving"] = """SELECT event_id, ts, least(3, (day(ts) - 1) // 8
        + CASE WHEN event_id % 7 = 0 THEN 2 WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) AS run FROM events"""
_CTES["arrivals"] = """SELECT *, false AS again FROM arriving
    UNION ALL SELECT event_id, ts, least(3, run + 1), true FROM arriving WHERE event_id % 5 = 0"""
_CTES["arrivals_judged"] = """SELECT a.*, coalesce(a.ts < (SELECT max(b.ts) FROM arrivals b WHERE b.run < a.run) - INTERVAL 6 DAY, false) AS late
    FROM arrivals a"""
_oracle(
    "arrival_verdicts",
    """SELECT event_id AS seq, run::INT AS run, CASE WHEN late THEN 'late'
        WHEN row_number() OVER (PARTITION BY event_id, late ORDER BY run, again) > 1 THEN 'repeated' ELSE 'accepted' END AS reason
    FROM arrivals_judged""",
)
_oracle("signal_stream_accepted", "SELECT session_id, seq, action, state, next_state FROM sound_trace")
ORACLES["signal_stream_rejects"] = ORACLES["rejected_actions"]
_oracle(
    "signal_stream",
    """SELECT t.session_id, t.seq, t.action, t.state, t.next_state,
    coalesce(sum((x.action <> 'BATCH')::INT) OVER (PARTITION BY x.session_id ORDER BY x.n
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS has_embeddings,
    least(sum((x.action <> 'BATCH')::INT) OVER (PARTITION BY x.session_id ORDER BY x.n), 50)::INT AS profile_size
    FROM trace t JOIN numbered x ON t.session_id = x.session_id AND t.n = x.n""",
)
_oracle(
    "update_state",
    """SELECT session_id, arg_max(next_state, n) AS state, bool_or(action <> 'BATCH') AS has_embeddings
    FROM trace GROUP BY session_id""",
)
_CTES["stream_ask"] = """SELECT t.session_id || ':' || t.seq AS session_id, t.session_id AS own, t.state, t.batch_type,
    x.blueprint, x.ts, x.seq
    FROM trace t JOIN numbered x ON t.session_id = x.session_id AND t.n = x.n WHERE t.action = 'BATCH'"""
_CTES["live_log"] = """SELECT a.session_id, s.item_id, s.weight,
    row_number() OVER (PARTITION BY a.session_id ORDER BY s.ts DESC, s.seq DESC) - 1 AS q_idx
    FROM slog s JOIN stream_ask a ON s.session_id = a.own AND (s.ts, s.seq) < (a.ts, a.seq)"""
_CTES["live_profile"] = """SELECT l.session_id, l.q_idx, i.e, l.weight FROM live_log l JOIN items i ON l.item_id = i.id
    WHERE q_idx < 50"""
_CTES["live_ask"] = """SELECT a.session_id, a.batch_type, nd.last_n, nd.n_topics, nd.threshold, nd.mmr
    FROM stream_ask a JOIN nodes nd ON nd.blueprint = a.blueprint AND nd.name = a.state"""
_CTES["live_chance"] = _CTES["ask_chance"].replace("asked", "live_ask").replace("profile", "live_profile")
_CTES["live_personal"] = "SELECT * FROM live_ask WHERE batch_type = 'personalized'"
_CTES["live_biased"] = "SELECT * FROM live_ask WHERE batch_type = 'biased'"
_CTES["live_sampled"] = "SELECT * FROM live_ask WHERE batch_type = 'sampled'"
_CTES["live_own"] = _own("live_personal").replace("profile p", "live_profile p")
_CTES["live_biased_own"] = _own("live_biased").replace("profile p", "live_profile p")
_CTES["live_biased_w"] = _with_bias("live_biased_own", "live_biased", "split_part(r.session_id, ':', 1)::BIGINT")
_CTES["live_drawn"] = _drawn("live_sampled")
_budgets("live_own_q", "live_own", "live_personal")
_budgets("live_biased_q", "live_biased_w", "live_biased")
_budgets("live_drawn_q", "live_drawn", "live_sampled")
_random_vectors("live_r", "live_chance", 10, 0)
_CTES["live_q"] = f"""SELECT * FROM live_own_q UNION ALL BY NAME SELECT * FROM live_biased_q
    UNION ALL BY NAME SELECT * FROM live_drawn_q UNION ALL BY NAME {_chance('live_r')}"""
# Request after request: what a session has signalled before each, and what its earlier ones
# gave. No session of the tables has more requests than MOST_TURNS.
_CTES["live_turn"] = """SELECT *, row_number() OVER (PARTITION BY own ORDER BY ts, seq) AS turn,
    session_id NOT IN (SELECT session_id FROM live_chance) AS minds FROM stream_ask"""
_CTES["live_shown_0"] = "SELECT NULL::BIGINT AS own, NULL::BIGINT AS id WHERE false"
MOST_TURNS = 28
for _turn in range(1, MOST_TURNS + 1):
    _CTES[f"live_q_{_turn}"] = f"SELECT * FROM live_q WHERE session_id IN (SELECT session_id FROM live_turn WHERE turn = {_turn})"
    _CTES[f"live_hist_{_turn}"] = f"""SELECT l.session_id, l.item_id AS hv FROM live_log l
        JOIN live_turn t ON t.session_id = l.session_id AND t.turn = {_turn} AND t.minds
        UNION SELECT t.session_id, s.id FROM live_shown_{_turn - 1} s JOIN live_turn t ON t.own = s.own AND t.turn = {_turn} AND t.minds"""
    _batch(f"live{_turn}", f"live_q_{_turn}", f"live_hist_{_turn}")
    _CTES[f"live_shown_{_turn}"] = f"""SELECT * FROM live_shown_{_turn - 1} UNION ALL
        SELECT t.own, p.id FROM live{_turn}_pool p JOIN live_turn t USING (session_id) WHERE p.position <= 10"""
_CTES["live_served"] = " UNION ALL ".join(
    f"SELECT session_id, position, id, score FROM live{t}_pool WHERE position <= 10" for t in range(1, MOST_TURNS + 1)
)
_oracle("batch_stream", "SELECT session_id AS request, position, id, round(score, 6) AS score FROM live_served")
_oracle(
    "stream_requests",
    """SELECT a.session_id AS request, a.state, a.batch_type, coalesce(b.n, 0) AS n_served FROM stream_ask a
    LEFT JOIN (SELECT session_id, count(*) AS n FROM live_served GROUP BY session_id) b USING (session_id)""",
)
ORACLES["indexed_dot_search"] = ORACLES["multi_search_dot"]
ORACLES["indexed_prior_filter"] = ORACLES["history_prior_filter"]
