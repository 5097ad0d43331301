"""SQL counterparts of the registered queries, for the same Parquet tables.

Each statement is a WITH chain of the named steps below and one final SELECT.
"""

from __future__ import annotations


def draw(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::bigint"


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) as {n}" for n in names)


def off_tie(value: str) -> str:
    """6 digits, after a shift that keeps multiples of powers of two off the rounding ties."""
    return f"round({value} + 1.3e-7::double, 6)"


FORM = r"'(?i)([^ ,.])([ ,.]+(gmbh|corp|llc|ltd|inc|pty|co|plc|s\.?a)[.]?)+$'"


def clean(name: str) -> str:
    return rf"regexp_replace({name}, {FORM}, '\1')"


STEPS: dict[str, str] = {
    "rel": """
        select event_id as eid, user_id as src_id,
               cast(regexp_extract(props, '[0-9]+', 0) as bigint) as dst_id,
               'Company#' || lpad(cast(user_id as varchar), 9, '0')
                 || case event_id % 6 when 0 then ' LLC' when 1 then ' Ltd.' when 2 then ', Inc.'
                                      when 3 then ' GmbH' when 4 then ' Co. Pty Ltd' else '' end as Purchaser,
               'Company#' || lpad(regexp_extract(props, '[0-9]+', 0), 9, '0')
                 || case event_id % 5 when 0 then ' Ltd.' when 1 then ' S.A.' when 2 then ' llc'
                                      when 3 then '' else ' Corp' end as Seller,
               value / (value + 25::double) as probability
        from events""",
    "silver": f"""
        select eid, src_id, dst_id, {clean('Purchaser')} as Purchaser, {clean('Seller')} as Seller, probability
        from rel where probability >= 0.55::double""",
    "e": "select eid, src_id, dst_id from silver",
    "orders_e": """
        select o_custkey as src_id, l_suppkey + 1000000 as dst_id
        from lineitem join orders on l_orderkey = o_orderkey""",
    "early_e": """
        select o_custkey as src_id, l_suppkey + 1000000 as dst_id from lineitem join orders on l_orderkey = o_orderkey
        where o_orderdate::date < (select min(o_orderdate)::date + 3 from orders)""",
    "nodes": "select src_id as id from e union select dst_id from e",
    "dense": "select unnest(range(0, (select max(greatest(src_id, dst_id)) + 1 from e))) as id",
    "placed": "select *, row_number() over (order by eid) - 1 as pos, count(*) over () as n from e",
    "split": """
        select eid, src_id, dst_id,
               case when pos < n - floor(0.2::double * n) - floor(0.1::double * n) then 'training'
                    when pos < n - floor(0.1::double * n) then 'validation' else 'testing' end as split
        from placed""",
    "batches": f"""
        select *, (row_number() over (partition by split order by {draw("'batch|0|' || eid")}, eid) - 1) // 64 as batch_id
        from split""",
    "all_batches": f"""
        select eid, (row_number() over (order by {draw("'batch|0|' || eid")}, eid) - 1) // 64 as batch_id from e""",
    "node_index": "select id, row_number() over (order by id) - 1 as ix from nodes",
    "neg_dense": f"""
        select eid, src_id, {draw("'negative|0|' || eid || '|' || j")} % (select count(*) from dense) as dst_id, j as draw
        from e, (select unnest([1, 2, 3]) as j)""",
    "examples": """
        select eid, src_id, dst_id, 0 as draw, 1 as label from e
        union all select eid, src_id, dst_id, draw, 0 from neg_dense""",
    "dims": "select unnest(range(0, 4)) as i",
    "x": f"select id, i as j, ({draw("'f|' || id || '|' || i")} % 2001 - 1000)::double as v from dense, dims",
    "orders_x": f"""
        select id, i as j, ({draw("'f|' || id || '|' || i")} % 2001 - 1000)::double as v
        from (select src_id as id from orders_e union select dst_id from orders_e), dims""",
}


def weight(k: int, row: str, col: str) -> str:
    return f"((3 * {row} + 5 * {col} + 2 * {k}) % 7 - 3) / 4::double"


def layer(
    out: str, src: str, edges: str, k_self: int, k_neigh: int, relu: bool, pool: int | None = None, dims: str = "dims",
    pool_dims: str = "dims",
) -> dict[str, str]:
    """One aggregation layer in long form (id, j, v); ``dims`` number its outputs, ``pool_dims`` its inputs."""
    steps = {}
    nbr = src
    if pool is not None:
        nbr = f"{out}_p"
        steps[nbr] = f"""
            select id, i as j, greatest(0, sum({weight(pool, 'i', 'j')} * v) + 125) as v
            from {src}, {pool_dims} group by id, i"""
    how = "avg" if pool is None else "max"
    steps[f"{out}_agg"] = f"select dst_id as id, j, {how}(v) as m from {edges} join {nbr} on id = src_id group by dst_id, j"
    value = f"sum({weight(k_self, 'i', 'a.j')} * a.v + {weight(k_neigh, 'i', 'a.j')} * coalesce(g.m, 0)) + 125"
    steps[out] = f"""
        select a.id, i as j, {f'greatest(0, {value})' if relu else value} as v
        from {src} a left join {out}_agg g on a.id = g.id and a.j = g.j, {dims} group by a.id, i"""
    return steps


STEPS |= layer("h1", "x", "e", 0, 1, True)
STEPS |= layer("h2", "h1", "e", 3, 4, False)
STEPS |= layer("h2r", "h1", "e", 3, 4, True)
STEPS |= layer("q1", "x", "e", 0, 1, True, pool=2)
STEPS |= layer("q2", "q1", "e", 3, 4, False, pool=5)
STEPS |= layer("o1", "orders_x", "orders_e", 0, 1, True)
STEPS |= layer("o2", "o1", "orders_e", 3, 4, False)
for _n in (15, 20, 50, 100):
    STEPS[f"dims{_n}"] = f"select unnest(range(0, {_n})) as i"
for _n in (15, 50):
    STEPS[f"x{_n}"] = f"select id, i as j, ({draw("'f|' || id || '|' || i")} % 2001 - 1000)::double as v from dense, dims{_n}"
STEPS |= layer("d1", "x15", "e", 0, 1, True, dims="dims20")
STEPS |= layer("d2", "d1", "e", 3, 4, False, dims="dims15")
STEPS |= layer("w1", "x50", "e", 0, 1, True, 2, "dims100", "dims50")
STEPS |= layer("w2", "w1", "e", 3, 4, False, 5, "dims50", "dims100")
for _n in (1, 2):
    STEPS[f"s{_n}"] = f"""
        select eid, src_id, dst_id, slot from (
          select *, row_number() over (partition by dst_id order by {draw(f"'fanout|0|{_n}|' || eid")}, eid)::int as slot from e)
        where slot <= 4"""
    STEPS[f"t{_n}"] = f"""
        select eid, src_id, dst_id, slot from (
          select *, row_number() over (partition by dst_id order by {draw(f"'fanout|0|{_n}|' || eid")}, eid)::int as slot
          from split where split = 'training')
        where slot <= 4"""
for _n in range(3):
    STEPS[f"e_{_n}"] = f"select src_id, dst_id from e where eid % 3 <= {_n}"
    STEPS[f"x_{_n}"] = f"select * from x where id in (select src_id from e_{_n} union select dst_id from e_{_n})"
    STEPS |= layer(f"k{_n}", f"x_{_n}", f"e_{_n}", 0, 1, True)
    STEPS |= layer(f"l{_n}", f"k{_n}", f"e_{_n}", 3, 4, False)
STEPS |= layer("f1", "x", "s1", 0, 1, True)
STEPS |= layer("f2", "f1", "s2", 3, 4, False)
STEPS |= layer("g1", "x", "t1", 0, 1, True)
STEPS |= layer("g2", "g1", "t2", 3, 4, False)


def halves(step: str) -> str:
    return f"""
        select id, sum(((3 * j + 1) % 5 - 2) / 4::double * v) / 1000 as a,
               sum(((3 * (j + 4) + 1) % 5 - 2) / 4::double * v) / 1000 as b
        from {step} group by id"""


def batch_metrics(step: str, by: str) -> str:
    return f"""
        select {by}, count(*) as n_examples, sum(label) as p, count(*) - sum(label) as n,
               sum(case when label = 1 then mid end) as ranks, sum(label * above_pos / above_all::double) / sum(label) as ap
        from (select *, rank() over (partition by {by} order by score)
                        + (count(*) over (partition by {by}, score) - 1) / 2::double as mid,
                     sum(label) over (partition by {by} order by score desc) as above_pos,
                     count(*) over (partition by {by} order by score desc) as above_all
              from {step})
        group by {by}"""


AUC = "(ranks - p * (p + 1) / 2::double) / (p::double * n)"
STEPS |= {
    "held": """
        select split, batch_id, src_id, dst_id, 1 as label from batches where split <> 'training'
        union all
        select split, batch_id, n.src_id, n.dst_id, 0 from batches b join neg_dense n on n.eid = b.eid where split <> 'training'""",
    "held_ends": halves("g2"),
    "held_scored": """
        select h.*, round(u.a + v.b + 1 + 1.3e-10::double, 9) as score
        from held h join held_ends u on u.id = src_id join held_ends v on v.id = dst_id""",
    "held_metrics": batch_metrics("held_scored", "split, batch_id"),
    "ends": halves("h2"),
    "scored": """
        select s.*, 1 / (1 + exp(-(u.a + v.b + 1))) as gnn_prediction
        from silver s left join ends u on u.id = src_id left join ends v on v.id = dst_id""",
    "refined": """
        select s.*, case when gnn_prediction >= probability then gnn_prediction else probability end as refined_probability
        from scored s""",
    "ex_scored": """
        select x.*, round(u.a + v.b + 1 + 1.3e-10::double, 9) as score
        from examples x join ends u on u.id = src_id join ends v on v.id = dst_id""",
    "ex_batched": "select x.*, batch_id from ex_scored x join all_batches using (eid)",
    "by_batch": batch_metrics("ex_batched", "batch_id"),
    "auc_batch": f"select batch_id, n_examples, {AUC} as auc, ap from by_batch",
    "locations": """
        select c_custkey as company_id, n_name as country, r_name as region
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "country_risk": "select n_name as country, ((n_nationkey * 37) % 100)::double / 10 as risk_premium from nation",
    "profiles": """
        select company_id, l.country, region, risk_premium, c_acctbal / 10000::double as risk_score
        from locations l left join country_risk r on l.country = r.country left join customer on company_id = c_custkey""",
    "enriched": """
        select s.*, b.country as buyer_country, b.region as buyer_region, b.risk_premium as buyer_risk_premium,
               b.risk_score as buyer_risk_score, t.country as seller_country, t.region as seller_region,
               t.risk_premium as seller_risk_premium, t.risk_score as seller_risk_score
        from (select eid, src_id, dst_id, Purchaser, Seller, refined_probability as probability from refined) s
             left join profiles b on b.company_id = src_id left join profiles t on t.company_id = dst_id""",
    "links": "select distinct src_id, dst_id from e where src_id <> dst_id",
    "walk": """
        select src_id as root, dst_id as company, 1 as tier from links
        where src_id in (select c_custkey from customer where c_acctbal / 10000::double < -0.05::double)
        union select w.root, l.dst_id, w.tier + 1 from walk w join links l on l.src_id = w.company where w.tier < 3""",
    "spelled": f"""
        select eid, src_id * 10 + eid % 6 as src_id, dst_id * 10 + eid % 5 as dst_id,
               {clean('Purchaser')} as Purchaser, {clean('Seller')} as Seller from rel""",
    "canon": """
        select name, min(id) as id
        from (select src_id as id, Purchaser as name from spelled union all select dst_id, Seller from spelled) group by name""",
    "q": """
        select quantile_cont(probability, 0.25) as q1, quantile_cont(probability, 0.5) as median,
               quantile_cont(probability, 0.75) as q3 from rel""",
}


def score_head(steps: int, lr: float) -> str:
    """Gradient steps of a linear scorer in long form: inputs (example, place, v), weights (place, value)."""
    chain = ["""
        inputs as (
          select x.eid, x.draw, x.label, j as place, v / 1e4 as v from examples x join h2 on id = src_id
          union all select x.eid, x.draw, x.label, j + 4, v / 1e4 from examples x join h2 on id = dst_id
          union all select eid, draw, label, 8, 1 from examples),
        n0 as (select place, 0::double as value from inputs group by place)"""]
    for k in range(1, steps + 1):
        chain.append(f"""
        z{k} as (select eid, draw, label, sum(v * value) as z from inputs join n{k - 1} using (place) group by eid, draw, label),
        n{k} as (select i.place, any_value(w.value) - {lr}::double * avg((1 / (1 + exp(-z)) - i.label) * v) as value
                 from inputs i join z{k} using (eid, draw) join n{k - 1} w on w.place = i.place group by i.place)""")
    rows = [f"select {k} as step, place::int as place, round(value, 6) as value from n{k}" for k in range(1, steps + 1)]
    return ", " + ", ".join(chain) + " " + " union all ".join(rows)


def axes(steps: int) -> str:
    """Two leading axes of the covariance of ``sample`` (id, j, v), by power iterations of four components."""
    dims = range(4)

    def walk(name: str, matrix: str) -> str:
        moved = [" + ".join(f"m{i}{j} * v{j}" for j in dims) for i in dims]
        squares = " + ".join(f"({m}) * ({m})" for m in moved)
        step = ", ".join(f"({m}) / sqrt({squares})" for m in moved)
        start = ", ".join(f"0.5::double as v{i}" for i in dims)
        return f"""
        {name}_walk as (select 0 as k, {start} union all
                        select k + 1, {step} from {name}_walk, {matrix} where k < {steps}),
        {name} as (select * from {name}_walk where k = {steps})"""

    wide = ", ".join(f"max(v) filter (j = {i}) as x{i}" for i in dims)
    entries = ", ".join(f"covar_samp(x{i}, x{j}) as m{i}{j}" for i in dims for j in dims)
    power = " + ".join(f"v{i} * m{i}{j} * v{j}" for i in dims for j in dims)
    left = ", ".join(f"m{i}{j} - ({power}) * v{i} * v{j} as m{i}{j}" for i in dims for j in dims)
    sign = lambda a: " ".join(
        f"when abs({a}.v{i}) >= greatest({', '.join(f'abs({a}.v{j})' for j in dims)}) then sign({a}.v{i})" for i in dims
    )
    on = lambda a: f"(case {sign(a)} end) * ({' + '.join(f'x{i} * {a}.v{i}' for i in dims)})"
    return f"""
        , wide as (select id, {wide} from sample group by id),
        c1 as (select {entries} from wide), {walk('a1', 'c1')},
        c2 as (select {left} from c1, a1), {walk('a2', 'c2')}
        select id, round({on('a1')}, 6) as x, round({on('a2')}, 6) as y from wide, a1, a2"""


def with_steps(*names: str, final: str) -> str:
    """The named steps in their listed order, then the final SELECT."""
    wanted = [n for n in STEPS if n in names]
    missing = set(names) - set(wanted)
    if missing:
        raise KeyError(missing)
    body = ", ".join(f"{n} as ({STEPS[n].strip()})" for n in wanted)
    return f"with recursive {body} {final}"


GRAPH = ("rel", "silver", "e")
FIXED = (*GRAPH, "dense", "dims", "x")
EMBED = (*FIXED, "h1_agg", "h1", "h2_agg", "h2")
SCORE = (*EMBED, "ends", "scored")
EXAMPLES = (*EMBED, "ends", "neg_dense", "examples", "ex_scored")
BATCHED = (*EXAMPLES, "all_batches", "ex_batched", "by_batch", "auc_batch")


def vector(step: str, value: str = "v", keep: str = "") -> str:
    return f"select id, j::int as dim, {off_tie(value)} as value from {step} {keep}"


def oracle_sql() -> dict[str, str]:
    names = "Purchaser, Seller"
    edge = "eid, src_id, dst_id"
    unit = "('0x' || substr(md5({t}), {at}, 15))::bigint::double"
    digest = "'feature|0|' || id || '|' || (k // 2)"
    u1 = f"(({unit.format(t=digest, at=1)} + 0.5::double) / 1152921504606846976::double)"
    u2 = f"(({unit.format(t=digest, at=16)} + 0.5::double) / 1152921504606846976::double)"
    normal = f"(sqrt(-2 * ln({u1})) * case when k % 2 = 0 then cos(2 * pi() * {u2}) else sin(2 * pi() * {u2}) end)::float::double"
    negatives = f"""
        select eid, src_id, id as dst_id, j as draw
        from e, (select unnest(range(1, {{top}}))::int as j) join node_index
          on ix = {draw("'negative|0|' || eid || '|' || j")} % (select count(*) from nodes)"""
    open_draw = lambda j, m: f"({draw(f"'open|0|' || eid || '|{j}'")} % {m})"
    fanned = lambda n: f"select dst_id as node_id, src_id as nbr_id, eid, slot, {n} as layer from s{n}"
    return {
        "confidence_filter": with_steps(
            "rel", final=f"select {edge}, {r6('probability')} from rel where probability >= 0.55::double"
        ),
        "clean_names": with_steps(
            "rel", final=f"select eid, {clean('Purchaser')} as Purchaser, {clean('Seller')} as Seller from rel"
        ),
        "cast_probability": """
            select event_id as eid,
                   round(try_cast(case when event_type = 'error' then event_type else value::varchar end as double), 6)
                     as probability
            from events""",
        "silver_relations": with_steps("rel", "silver", final=f"select {edge}, {names}, {r6('probability')} from silver"),
        "edge_projection": with_steps(*GRAPH, final=f"select {edge} from e"),
        "csv_dimension": with_steps("country_risk", final=f"select country, {r6('risk_premium')} from country_risk"),
        "probability_profile": with_steps(
            "rel", "q",
            final=f"""
            select count(probability) as n, count(*) - count(probability) as n_missing,
                   count(*) filter (where probability < q1 - 1.5 * (q3 - q1) or probability > q3 + 1.5 * (q3 - q1)) as n_outliers,
                   round(min(probability), 6) as min_p, round(max(probability), 6) as max_p, round(avg(probability), 6) as mean_p,
                   round(min(probability) filter (where probability >= q1 - 1.5 * (q3 - q1)), 6) as whisker_low,
                   round(max(probability) filter (where probability <= q3 + 1.5 * (q3 - q1)), 6) as whisker_high,
                   round(any_value(q1), 6) as q1, round(any_value(median), 6) as median, round(any_value(q3), 6) as q3
            from rel, q""",
        ),
        "probability_histogram": with_steps(
            "rel",
            final="""
            select bin, count(*) as n, round((bin - 1) / 20::double, 6) as bin_start,
                   round(count(*) * 20::double / (select count(probability) from rel), 6) as density
            from (select least(floor(probability * 20)::bigint + 1, 20) as bin from rel where probability is not null)
            group by bin""",
        ),
        "probability_density": with_steps(
            "rel", "q",
            final="""
            , s as (select count(probability) as n, min(probability) as low, max(probability) as high,
                           stddev_samp(probability) as sd, any_value(q3) - any_value(q1) as iqr from rel, q),
            w as (select *, (high - low) / 255 as step, 0.9::double * least(sd, iqr / 1.34::double) * pow(n, -0.2::double) as h from s),
            bins as (select floor((probability - low) / step + 0.5::double) as bin, count(*) as c
                     from rel, w where probability is not null group by bin)
            select round(any_value(low + point * step), 6) as at,
                   round(sum(c * exp(-0.5::double * pow((point - bin) * step / h, 2)) / (sqrt(2 * pi()) * h * n)), 6) as density
            from bins, w, (select unnest(range(0, 256)) as point) group by point""",
        ),
        "degree_power_law": with_steps(
            *GRAPH, "nodes",
            final="""
            , ends as (select 'out' as direction, src_id as id from e union all select 'in', dst_id from e),
            deg as (select direction, id, count(*) as d from ends group by direction, id),
            hist as (select direction, d, count(*) as c from deg group by direction, d),
            tails as (select *, sum(c) over up as above, sum(c * ln(d::double)) over up as logs,
                             sum(c) over (partition by direction) as n, max(d) over (partition by direction) as top
                      from hist window up as (partition by direction order by d desc rows unbounded preceding)),
            tried as (select direction, d as cutoff, above as n_tail, 1 + above / (logs - above * ln(d - 0.5::double)) as exponent
                      from tails where above >= 0.1::double * n and d < top),
            fits as (select direction, cutoff, n_tail, exponent,
                            max(abs(above / n_tail::double - pow((d - 0.5::double) / (cutoff - 0.5::double), 1 - exponent))) as distance
                     from tails join tried using (direction) where d >= cutoff group by all)
            select direction, cutoff, n_tail::bigint as n_tail, round(exponent, 6) as exponent, round(distance, 6) as distance
            from (select *, row_number() over (partition by direction order by distance, cutoff) as place from fits) where place = 1""",
        ),
        "tier_sizes": with_steps(
            *GRAPH, "links",
            final="""
            , w1 as (select distinct src_id as id, dst_id as c from links),
            w2 as (select * from w1 union select l.src_id, w.c from links l join w1 w on w.id = l.dst_id),
            w3 as (select * from w1 union select l.src_id, w.c from links l join w2 w on w.id = l.dst_id)
            select id, (select count(*) from w1 where w1.id = i.id) as within_1, (select count(*) from w2 where w2.id = i.id) as within_2,
                   (select count(*) from w3 where w3.id = i.id) as within_3
            from (select distinct id from w1) i""",
        ),
        "graph_counts": with_steps(
            *GRAPH, "nodes",
            final="""select count(*) as n_edges, (select count(*) from nodes) as n_nodes,
                            max(greatest(src_id, dst_id)) + 1 as n_dense_nodes from e""",
        ),
        "node_set": with_steps(*GRAPH, "nodes", final="select id from nodes"),
        "degrees": with_steps(
            *GRAPH, "nodes",
            final="""select id, (select count(*) from e where src_id = id) as out_degree,
                            (select count(*) from e where dst_id = id) as in_degree from nodes""",
        ),
        "degree_distribution": with_steps(
            *GRAPH, "nodes",
            final="""
            select 'out' as direction, d as degree, count(*) as n_nodes
            from (select id, count(eid) as d from nodes left join e on src_id = id group by id) group by d
            union all select 'in', d, count(*)
            from (select id, count(eid) as d from nodes left join e on dst_id = id group by id) group by d""",
        ),
        "hubs": with_steps(
            *GRAPH, "nodes",
            final="""select * from (select id, (select count(*) from e where src_id = id) as out_degree,
                            (select count(*) from e where dst_id = id) as in_degree from nodes)
                     where greatest(out_degree, in_degree) >= 0.01::double * (select count(*) from e)""",
        ),
        "order_graph_counts": with_steps(
            "orders_e",
            final="""select count(*) as n_edges, count(distinct src_id) + count(distinct dst_id) as n_nodes,
                            max(greatest(src_id, dst_id)) + 1 as n_dense_nodes from orders_e""",
        ),
        "edge_split": with_steps(*GRAPH, "placed", "split", final=f"select {edge}, split from split"),
        "edge_split_sizes": with_steps(
            *GRAPH, "placed", "split", final="select split, count(*) as n_edges from split group by split"
        ),
        "edge_batches": with_steps(
            *GRAPH, "placed", "split", "batches", final=f"select {edge}, split, batch_id from batches"
        ),
        "capped_batches": with_steps(
            *GRAPH, "placed", "split", "batches",
            final="select split, batch_id, count(*) as n_edges from batches where batch_id < 10 group by all",
        ),
        "node_features": with_steps(
            *GRAPH, "nodes",
            final=f"""
            select id, k::int as dim,
                   {off_tie(normal)} as value
            from nodes, (select unnest(range(0, 15)) as k)""",
        ),
        "given_node_features": with_steps(
            *GRAPH, "nodes",
            final=f"""
            select id, k::int as dim, {off_tie('coalesce(embedding[k + 1]::double, 0)')} as value
            from nodes left join embeddings on vec_id = id, (select unnest(range(0, 64)) as k)""",
        ),
        "exact_sample": with_steps(
            *GRAPH, "nodes",
            final=f"""
            select id from (select id, row_number() over (order by {draw("'sample|0|' || id")}, id) as rn, count(*) over () as n
                            from nodes) where rn <= round_even(n * 0.1::double, 0)""",
        ),
        "fanout_sample": with_steps(
            *GRAPH, "s1", final="select dst_id as node_id, src_id as nbr_id, eid, slot from s1"
        ),
        "two_hop_blocks": with_steps(
            *GRAPH, "dense", "neg_dense", "examples", "s1", "s2",
            final=f"""
            , seeds as (select src_id as id from examples union select dst_id from examples),
            outer_e as (select * from ({fanned(2)}) where node_id in (select id from seeds)),
            frontier as (select id from seeds union select nbr_id from outer_e)
            select * from outer_e union all select * from ({fanned(1)}) where node_id in (select id from frontier)""",
        ),
        "fresh_blocks": with_steps(
            *GRAPH, "all_batches",
            final=f"""
            , seeds as (select batch_id, unnest([src_id, dst_id]) as id from e join all_batches using (eid) where batch_id < 4),
            drawn as (
              select batch_id, layer, dst_id as node_id, src_id as nbr_id, eid,
                     row_number() over (partition by batch_id, layer, dst_id
                                        order by {draw("'fresh|0|' || layer || '|' || batch_id || '|' || eid")}, eid)::int as slot
              from e, (select unnest([0, 1, 2, 3])::bigint as batch_id), (select unnest([1, 2])::int as layer)),
            outer_e as (select * from drawn where layer = 2 and slot <= 4 and (batch_id, node_id) in (select batch_id, id from seeds)),
            frontier as (select * from seeds union select batch_id, nbr_id from outer_e)
            select * from outer_e union all
            select * from drawn where layer = 1 and slot <= 4 and (batch_id, node_id) in (select * from frontier)""",
        ),
        "negatives_uniform": with_steps(*GRAPH, "nodes", "node_index", final=negatives.format(top=4)),
        "negatives_dense": with_steps(*GRAPH, "dense", "neg_dense", final="select eid, src_id, dst_id, draw from neg_dense"),
        "negatives_strict": with_steps(
            *GRAPH, "nodes", "node_index",
            final=f"""
            , drawn as ({negatives.format(top=7)}),
            kept as (select * from drawn d where not exists
                       (select 1 from e where e.src_id = d.src_id and e.dst_id = d.dst_id))
            select eid, src_id, dst_id, draw
            from (select *, row_number() over (partition by eid order by draw) as rn from kept) where rn <= 3""",
        ),
        "negatives_strict_exact": with_steps(
            *GRAPH, "nodes", "node_index",
            final=f"""
            , sold as (select distinct src_id, dst_id from e),
            free as (select u.id as src_id, ix, row_number() over (partition by u.id order by ix) - 1 as open
                     from nodes u join node_index v on true
                     where not exists (select 1 from sold where sold.src_id = u.id and sold.dst_id = v.id)),
            n_free as (select src_id, count(*) as m from free group by src_id),
            d1 as (select e.*, m, {open_draw(1, 'm')} as r1 from e join n_free using (src_id)),
            d2 as (select *, case when {open_draw(2, 'greatest(m - 1, 1)')} >= r1 then 1 else 0 end
                             + {open_draw(2, 'greatest(m - 1, 1)')} as r2 from d1),
            d3 as (select *, {open_draw(3, 'greatest(m - 2, 1)')} as x from d2),
            d4 as (select *, case when x >= least(r1, r2) then x + 1 else x end as y from d3),
            drawn as (select *, case when y >= greatest(r1, r2) then y + 1 else y end as r3 from d4),
            long as (select eid, src_id, m, 1 as draw, r1 as open from drawn
                     union all select eid, src_id, m, 2, r2 from drawn union all select eid, src_id, m, 3, r3 from drawn)
            select eid, src_id, id as dst_id, draw::int as draw
            from long join free using (src_id, open) join node_index using (ix) where draw <= m""",
        ),
        "labelled_examples": with_steps(
            *GRAPH, "dense", "neg_dense", "examples", final=f"select {edge}, draw, label from examples"
        ),
        "neighbour_mean_features": with_steps(*FIXED, "h1_agg", final=vector("h1_agg", "m")),
        "neighbour_max_features": with_steps(*FIXED, "q1_p", "q1_agg", final=vector("q1_agg", "m")),
        "sage_layer_mean": with_steps(*FIXED, "h1_agg", "h1", final=vector("h1")),
        "sage_layer_pool": with_steps(*FIXED, "q1_p", "q1_agg", "q1", final=vector("q1")),
        "sage_embeddings": with_steps(*EMBED, final=vector("h2")),
        "sage_embeddings_pool": with_steps(
            *FIXED, "q1_p", "q1_agg", "q1", "q2_p", "q2_agg", "q2", final=vector("q2")
        ),
        "sage_embeddings_rectified": with_steps(*FIXED, "h1_agg", "h1", "h2r_agg", "h2r", final=vector("h2r")),
        "sampled_embeddings": with_steps(
            *FIXED, "s1", "s2", "f1_agg", "f1", "f2_agg", "f2", final=vector("f2")
        ),
        "sage_embeddings_default_width": with_steps(
            *GRAPH, "dense", "dims15", "dims20", "x15", "d1_agg", "d1", "d2_agg", "d2", final=vector("d2")
        ),
        "sage_embeddings_tuned_width": with_steps(
            *GRAPH, "dense", "dims50", "dims100", "x50", "w1_p", "w1_agg", "w1", "w2_p", "w2_agg", "w2", final=vector("w2")
        ),
        "train_score_head": with_steps(*EMBED, "neg_dense", "examples", final=score_head(3, 0.5)),
        "batch_losses": with_steps(
            *FIXED, "placed", "split", "batches", "t1", "t2", "g1_agg", "g1", "g2_agg", "g2", "held_ends",
            final=f"""
            , members as (select src_id as id from split where split = 'training' union select dst_id from split where split = 'training'),
            numbered as (select id, row_number() over (order by id) - 1 as ix from members),
            first as (select * from batches where split = 'training' and batch_id < 5),
            pairs as (select batch_id, src_id, dst_id, 1 as label from first union all
                      select batch_id, src_id, id, 0 from first, (select unnest([1, 2, 3]) as j) join numbered
                        on ix = {draw("'negative|0|' || eid || '|' || j")} % (select count(*) from members)),
            scores as (select p.*, u.a + v.b + 1 as z from pairs p join held_ends u on u.id = src_id join held_ends v on v.id = dst_id)
            select batch_id, round(avg(greatest(z, 0) - z * label + ln(1 + exp(-abs(z)))), 6) as loss,
                   round(avg(1 / (1 + exp(-z)) - label), 6) as bias_gradient
            from scores group by batch_id""",
        ),
        "embedding_axes": with_steps(
            *EMBED,
            final=f"""
            , chosen as (select id from (select id, row_number() over (order by {draw("'sample|0|' || id")}, id) as rn, count(*) over () as n
                                         from dense) where rn <= round_even(n * 0.3::double, 0)),
            sample as (select id, j, v / 1e4::double as v from h2 where id in (select id from chosen)){axes(60)}""",
        ),
        "stream_metrics": with_steps(
            "rel",
            final="""
            , counts as (select eid % 3 as step, count(*) as n, count(*) filter (probability >= 0.55::double) as kept from rel group by 1)
            select 'landing' as run_id, 'bronze' as split, step, 'rows_read' as name, (n + 1)::double as value from counts
            union all select 'landing', 'bronze', step, 'rows_corrupt', 1::double from counts
            union all select 'landing', 'silver', step, 'rows_kept', kept::double from counts""",
        ),
        "stream_embeddings": with_steps(
            *FIXED, *[f"{a}_{n}" for n in range(3) for a in ("e", "x")],
            *[f"{a}{n}{b}" for n in range(3) for a in "kl" for b in ("_agg", "")],
            final=" union all ".join(vector(f"l{n}").replace("select id", f"select {n} as landing, id") for n in range(3)),
        ),
        "new_company_embeddings": with_steps(
            "orders_e", "early_e", "dims", "orders_x", "o1_agg", "o1", "o2_agg", "o2",
            final=vector("o2", "v", "where id not in (select src_id from early_e union select dst_id from early_e)"),
        ),
        "order_graph_embeddings": with_steps(
            "orders_e", "dims", "orders_x", "o1_agg", "o1", "o2_agg", "o2", final=vector("o2")
        ),
        "link_score_linear": with_steps(
            *EMBED, "ends",
            final=f"""
            select src_id, dst_id, {off_tie('u.a + v.b + 1')} as logit, round(1 / (1 + exp(-(u.a + v.b + 1))), 6) as score
            from (select distinct src_id, dst_id from e) join ends u on u.id = src_id join ends v on v.id = dst_id""",
        ),
        "link_score_dot": with_steps(
            *EMBED,
            final=f"""
            select src_id, dst_id, {off_tie("sum(u.v * w.v) / 1e6::double")} as logit
            from (select distinct src_id, dst_id from e) join h2 u on u.id = src_id join h2 w on w.id = dst_id and w.j = u.j
            group by src_id, dst_id""",
        ),
        "score_relations": with_steps(
            *SCORE, final=f"select {edge}, {names}, {r6('probability', 'gnn_prediction')} from scored"
        ),
        "review_links": with_steps(
            *SCORE,
            final=f"""select {names}, {r6('probability', 'gnn_prediction')} from scored
                      where gnn_prediction > probability and gnn_prediction > 0.8::double and probability < 0.6::double""",
        ),
        "gold_refined": with_steps(
            *SCORE, "refined",
            final=f"select {edge}, {names}, round(refined_probability, 6) as probability from refined",
        ),
        "review_sql": with_steps(
            *SCORE,
            final=f"""select {names}, {r6('probability', 'gnn_prediction')} from scored
                      where gnn_prediction > probability and gnn_prediction > 0.8::double and probability < 0.6::double""",
        ),
        "refined_sql": with_steps(
            *SCORE, "refined",
            final=f"select {edge}, {names}, round(refined_probability, 6) as probability from refined",
        ),
        "rejected_links": with_steps(
            *EMBED, "ends",
            final=f"""
            , s as (select r.*, 1 / (1 + exp(-(u.a + v.b + 1))) as gnn_prediction
                    from rel r left join ends u on u.id = src_id left join ends v on v.id = dst_id
                    where probability < 0.55::double or probability is null)
            select {edge}, coalesce(gnn_prediction >= 0.55::double, false) as admitted,
                   {r6('probability', 'gnn_prediction')} from s""",
        ),
        "topk_missing_links": with_steps(
            *EMBED, "ends",
            final="""
            select src_id, dst_id, place::int as place, round(1 / (1 + exp(-(a + b + 1))), 6) as gnn_prediction
            from (select s.id as src_id, t.id as dst_id, s.a, t.b,
                         row_number() over (partition by s.id order by t.b desc, t.id) as place
                  from ends s join ends t on s.id <> t.id
                  where s.id in (select src_id from e)
                    and not exists (select 1 from e where e.src_id = s.id and e.dst_id = t.id))
            where place <= 5""",
        ),
        "topk_missing_dot": with_steps(
            *EMBED,
            final="""
            , grid as (select id, j, floor(v + 0.1234567::double) as v from h2),
            dots as (select u.id as src_id, w.id as dst_id, sum(u.v * w.v) as logit
                     from grid u join grid w on u.j = w.j and u.id <> w.id
                     where u.id in (select src_id from e) group by u.id, w.id)
            select src_id, dst_id, place::int as place, logit
            from (select d.*, row_number() over (partition by src_id order by logit desc, dst_id) as place from dots d
                  where not exists (select 1 from e where e.src_id = d.src_id and e.dst_id = d.dst_id))
            where place <= 5""",
        ),
        "auc_ap_by_batch": with_steps(
            *BATCHED, final=f"select batch_id, n_examples, {r6('auc', 'ap')} from auc_batch"
        ),
        "auc_ap_mean": with_steps(
            *BATCHED,
            final="select count(*) as n_batches, round(avg(auc), 6) as mean_auc, round(avg(ap), 6) as mean_ap from auc_batch",
        ),
        "metric_log": with_steps(
            *BATCHED,
            final="""
            select 'fixed' as run_id, 'all' as split, batch_id as step, 'AUC' as name, round(auc, 6) as value from auc_batch
            union all select 'fixed', 'all', batch_id, 'AP', round(ap, 6) from auc_batch""",
        ),
        "evaluate_fixed_model": with_steps(
            *FIXED, "placed", "split", "batches", "neg_dense", "t1", "t2", "g1_agg", "g1", "g2_agg", "g2",
            "held", "held_ends", "held_scored", "held_metrics",
            final=f"""select split, batch_id, n_examples, round({AUC}, 6) as auc, round(ap, 6) as ap from held_metrics""",
        ),
        "auc_ap_pooled": with_steps(
            *EXAMPLES,
            final="""
            , ranked as (select *, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2::double as mid,
                                sum(label) over (order by score desc) as up, count(*) over (order by score desc) as cnt
                         from ex_scored)
            select count(*) as n_examples,
                   round((sum(case when label = 1 then mid end) - sum(label) * (sum(label) + 1) / 2::double)
                         / (sum(label)::double * (count(*) - sum(label))), 6) as auc,
                   round(sum(label * up / cnt::double) / sum(label), 6) as ap from ranked""",
        ),
        "bce_loss": with_steps(
            *EXAMPLES,
            final="select round(avg(greatest(score, 0) - score * label + ln(1 + exp(-abs(score)))), 6) as bce_loss from ex_scored",
        ),
        "margin_loss": with_steps(
            *EXAMPLES,
            final="""
            select round(avg(greatest(0, 1 / (1 + exp(-n.score)) - 1 / (1 + exp(-p.score)) + 1)), 6) as margin_loss
            from ex_scored n join ex_scored p on p.eid = n.eid and p.label = 1 where n.label = 0""",
        ),
        "risk_enriched": with_steps(
            *SCORE, "refined", "locations", "country_risk", "profiles", "enriched",
            final=f"""
            select {edge}, {names}, buyer_country, buyer_region, seller_country, seller_region,
                   {r6('probability', 'buyer_risk_premium', 'buyer_risk_score', 'seller_risk_premium', 'seller_risk_score')}
            from enriched""",
        ),
        "risk_by_country": with_steps(
            *SCORE, "refined", "locations", "country_risk", "profiles", "enriched",
            final="""
            select buyer_country, seller_country, count(*) as n_relations, round(sum(probability), 6) as expected_relations,
                   round(max(seller_risk_premium), 6) as seller_risk_premium,
                   round(sum(probability * seller_risk_score) / sum(case when seller_risk_score is not null then probability end), 6)
                     as mean_seller_risk_score
            from enriched group by buyer_country, seller_country""",
        ),
        "supplier_tiers": with_steps(
            *GRAPH, "links", "walk",
            final="select root, company, min(tier)::int as tier from walk where root <> company group by root, company",
        ),
        "entity_resolution": with_steps(
            "rel", "spelled", "canon",
            final=f"""select eid, b.id as src_id, s.id as dst_id, {names}
                      from spelled join canon b on b.name = Purchaser join canon s on s.name = Seller""",
        ),
        "entity_components": with_steps(
            "rel",
            final=f"""
            , turned as (
              select eid, src_id * 10 + eid % 6 as src_id, dst_id * 10 + eid % 5 as dst_id, {clean('Seller')} as Seller,
                     case when src_id % 5 < 2 and eid % 7 = 0 then 'Company#' || lpad(cast(src_id + 1 as varchar), 9, '0')
                          else {clean('Purchaser')} end as Purchaser
              from rel),
            named as (select src_id as id, Purchaser as name from turned union select dst_id, Seller from turned),
            reach as (
              select id, id as other from named
              union
              select r.id, b.id from reach r join named a on a.id = r.other join named b on b.name = a.name),
            companies as (select id, min(other) as company from reach group by id)
            select eid, b.company as src_id, s.company as dst_id, {names}
            from turned join companies b on b.id = src_id join companies s on s.id = dst_id""",
        ),
        "stream_bronze": with_steps("rel", final=f"select {names}, src_id, dst_id, {r6('probability')} from rel"),
        "stream_silver": with_steps(
            "rel", "silver", final=f"select {names}, src_id, dst_id, {r6('probability')} from silver"
        ),
        "stream_text_confidence": with_steps(
            "rel", "silver", final=f"select {names}, src_id, dst_id, {r6('probability')} from silver"
        ),
        "stream_evolving": with_steps(
            "rel", "silver",
            final=f"""
            , extra as (select eid as x, round(case when eid % 3 = 0 then eid else eid + 0.5::double end, 6) as rank,
                               case when eid % 3 > 0 then eid % 5 end as tier from rel)
            select 'bronze' as layer, {names}, src_id, dst_id, tier, {r6('probability')}, rank from rel join extra on x = eid
            union all
            select 'bronze', null, null, null, null, null, null, null
            union all
            select 'silver', {names}, src_id, dst_id, tier, {r6('probability')}, rank from silver join extra on x = eid""",
        ),
        "namespace_tables": with_steps(
            "rel", "silver",
            final="""
            select 'company_risk_data' as name, count(*) as n, 'country,risk_premium' as columns from nation
            union all select 'company_locations', count(*), 'company,company_id,country,region' from customer
            union all select 'company_risk_frame', count(*), 'company_id,risk_score' from customer
            union all select 'gold_predictions', count(*), 'Purchaser,Seller,dst_id,eid,gnn_prediction,probability,src_id' from silver
            union all select 'gold_refined', count(*), 'Purchaser,Seller,dst_id,eid,probability,src_id' from silver""",
        ),
        "preview_sorted": with_steps(
            "rel", "silver", final=f"select {edge}, {r6('probability')} from silver order by eid limit 100"
        ),
        "contract_check": with_steps(
            "rel", "silver",
            final="""
            select 'silver' as name, true as kept, count(*) as n from silver
            union all select 'text_ids', false, count(*) from silver union all select 'no_seller', false, count(*) from silver""",
        ),
        "latest_weights": with_steps(
            *GRAPH,
            final="""
            select 'score.w' as name, i::int as place, 3 * i::double as value from (select unnest(range(0, 4)) as i)
            union all select 'score.b', 0, 3::double * count(*) from e""",
        ),
        "best_trial": """
            select user_id as trial, max(event_type) as params, round(max(value), 6) as loss
            from events group by user_id order by max(value), user_id limit 1""",
        "stream_score": with_steps(
            *SCORE, "refined",
            final=f"""select {names}, src_id, dst_id, {r6('probability', 'gnn_prediction', 'refined_probability')} from refined""",
        ),
    }
