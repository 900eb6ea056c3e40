"""Equivalent SQL for every catalog query, runnable by DuckDB over the same
parquet tables (views lineitem, part, ...).

Statements are assembled from shared WITH-clause pieces: the derived corpus,
the two graphs and PageRank. PageRank is a recursive CTE whose working table
is one round of deltas; it stops when a round produces no rows.
"""

from __future__ import annotations

from citeweave.plans.catalog import EMPTY_EVERY, SAMPLE_FRACTION, TOP_K, TRUNCATE_EVERY

CORPUS = """
cites as (
  select l_partkey pk, l_orderkey, l_linenumber, l_suppkey,
         lead(l_partkey) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) nxt
  from lineitem),
cited as (
  select *, concat(case when nxt % 11 = 0 then 'x' else '' end, cast(nxt as varchar)) c,
         concat('s', cast(l_suppkey as varchar)) s
  from cites),
oc as (
  select pk, l_orderkey,
         list_concat(coalesce(list(c order by l_linenumber, c) filter (where nxt is not null), cast([] as varchar[])),
                     list(s order by l_linenumber, s)) oc
  from cited group by pk, l_orderkey),
records as (
  select cast(p_partkey as varchar) id,
         concat(p_name, ' ', cast(p_partkey % 97 as varchar)) title,
         case when p_size % 10 = 0 then '' else concat(p_brand, '/', cast(p_size as varchar)) end journalName,
         coalesce(oc, cast([] as varchar[])) outCitations, p_partkey
  from part left join oc on pk = p_partkey),
pubs as (
  select id, title, journalName, outCitations from records
  union all select id, title, journalName, outCitations from records where p_partkey % 100 = 3
  union all select concat('s', cast(s_suppkey as varchar)), concat('Supplier of region ', cast(s_nationkey % 5 as varchar)),
                   case when s_nationkey % 5 <> 0 then concat('Nation/', cast(s_nationkey as varchar)) end,
                   case when s_suppkey % 2 = 0 then [cast(s_suppkey as varchar)]
                        else cast([] as varchar[]) end
  from supplier)"""

PUB_GRAPH_BASE = """
pv as (select id, min(title) name from pubs group by id),
dl as (select distinct id, outCitations from pubs),
ex as (select id src, unnest(outCitations) cited, unnest(range(len(outCitations))) pos from dl),
pe as (select src, cited dst from ex join pv on ex.cited = pv.id)"""

JOURNAL_GRAPH_BASE = """
pj as (select id, min(journalName) j from pubs where coalesce(journalName, '') <> '' group by id),
jsrc as (select journalName src, unnest(outCitations) cited from pubs where coalesce(journalName, '') <> ''),
je as (select src, pj.j dst, count(*) n from jsrc join pj on jsrc.cited = pj.id where src <> pj.j group by src, pj.j),
jv as (select distinct journalName id, journalName name from pubs where coalesce(journalName, '') <> '')"""


def _graph(prefix: str, v: str, e: str) -> str:
    """Degrees, PageRank and the attributed vertex table ``{prefix}g``."""
    p = prefix
    return f"""
{p}od as (select src id, count(*) k from {e} group by src),
{p}rk(step, id, delta) as (
  select 0, id, 0.15::double from {v}
  union all
  select {p}rk.step + 1, {e}.dst, 0.85 * sum({p}rk.delta / {p}od.k)
  from {p}rk join {e} on {e}.src = {p}rk.id join {p}od on {p}od.id = {p}rk.id
  where {p}rk.delta > 1e-4
  group by {p}rk.step, {e}.dst),
{p}rs as (select id, sum(delta) r from {p}rk group by id),
{p}pr as (select id, r * (select count(*) from {v}) / (select sum(r) from {p}rs) pr_raw from {p}rs),
{p}g as (
  select v.id, v.name,
         coalesce(i.c, 0)::bigint in_deg, coalesce(o.c, 0)::bigint out_deg,
         round(coalesce(pr.pr_raw, 0), 6) pr
  from {v} v
  left join (select dst id, count(*) c from {e} group by dst) i on i.id = v.id
  left join (select src id, count(*) c from {e} group by src) o on o.id = v.id
  left join {p}pr pr on pr.id = v.id)"""


def _with(*parts: str, recursive: bool = False) -> str:
    body = ",".join(parts)
    return ("with recursive" if recursive else "with") + body + "\n"


PUB = (CORPUS, PUB_GRAPH_BASE, _graph("p", "pv", "pe"))
JOUR = (CORPUS, JOURNAL_GRAPH_BASE, _graph("j", "jv", "je"))


def _top(g: str) -> str:
    return f"(select id, name, in_deg, out_deg, pr, row_number() over (order by pr desc, id) position " \
           f"from {g} order by pr desc, id limit {TOP_K})"


def _neighbors(e: str, seeds: str, direction: str) -> str:
    parts = []
    if direction in ("in", "either"):
        parts.append(f"select s.seed_id, e.src neighbor_id, 'in' via from {e} e join {seeds} s on e.dst = s.seed_id")
    if direction in ("out", "either"):
        parts.append(f"select s.seed_id, e.dst neighbor_id, 'out' via from {e} e join {seeds} s on e.src = s.seed_id")
    return " union all ".join(parts)


def _ranked(g: str, e: str, seeds: str, direction: str) -> str:
    return f"""(select nb.seed_id,
         row_number() over (partition by nb.seed_id order by g.pr desc, nb.neighbor_id, nb.via) rank,
         nb.neighbor_id, g.name, g.in_deg, g.out_deg, g.pr, nb.via
  from ({_neighbors(e, seeds, direction)}) nb join {g} g on g.id = nb.neighbor_id)"""


def _influential(g: str, e: str) -> str:
    return f"""
, seeds as (select v.name seed_name, v.id seed_id from {g} v where v.name in (select name from {_top(g)} t))
select s.seed_name, r.* from seeds s join {_ranked(g, e, '(select seed_id from seeds)', 'either')} r on r.seed_id = s.seed_id"""


def _report(g: str, e: str) -> str:
    return f"""
, seeds as (select position seed_position, id seed_id, name seed_name from {_top(g)} t)
select s.seed_position, s.seed_id, s.seed_name, r.rank, r.neighbor_id, r.name, r.in_deg, r.out_deg, r.pr, r.via
from seeds s join {_ranked(g, e, '(select seed_id from seeds)', 'in')} r on r.seed_id = s.seed_id"""


def _summary(g: str) -> str:
    return f"""select count(*) n_vertices, coalesce(sum(out_deg), 0)::bigint n_edges,
       count(*) filter (where in_deg > 0) n_with_in, count(*) filter (where out_deg > 0) n_with_out,
       count(distinct pr) n_distinct_pr, max(pr) max_pr, min(pr) min_pr from {g}"""


def _max_degree(g: str) -> str:
    def one(kind, deg):
        return f"(select '{kind}' kind, id, ({deg})::bigint degree from {g} order by {deg} desc, id limit 1)"
    return " union all ".join([one("in", "in_deg"), one("out", "out_deg"), one("total", "in_deg + out_deg")])


def _hex(expr: str, kind: str = "hugeint") -> str:
    digits = f"list_transform(string_split(lower({expr}), ''), lambda c: (instr('0123456789abcdef', c) - 1)::{kind})"
    return f"cast(list_reduce({digits}, lambda a, b: a * 16 + b) as varchar)"


def _damage(modulus: int) -> str:
    return f"cast('0x' || substr(md5(id), 1, 4) as bigint) % {modulus}"


def statements() -> dict[str, str]:
    c = _with(CORPUS)
    p = _with(*PUB, recursive=True)
    j = _with(*JOUR, recursive=True)
    pb = _with(CORPUS, PUB_GRAPH_BASE)
    jb = _with(CORPUS, JOURNAL_GRAPH_BASE)
    seeds_p = f"(select id seed_id from {_top('pg')} t)"
    threshold = SAMPLE_FRACTION * float(1 << 32)
    return {
        "scan_publications": c + "select id, title, journalName, len(outCitations)::bigint n_cited, "
                                 "array_to_string(outCitations, ' ') cited from pubs",
        "scan_quarantine": c + f"""select case when {_damage(TRUNCATE_EVERY)} = 0 then 'malformed' else 'missing_id' end reason,
       case when {_damage(TRUNCATE_EVERY)} = 0 then id end recovered_id
from pubs where {_damage(TRUNCATE_EVERY)} = 0 or {_damage(EMPTY_EVERY)} = 0""",
        "sample_by_hash": c + f"select id, title from pubs where cast('0x' || substr(md5(id || '|2'), 1, 8) as bigint) < {threshold!r}",
        "corpus_count": c + "select count(*) n_records from pubs",
        "publication_vertices": pb + "select id, name from pv",
        "distinct_citation_lists": pb + "select id, len(outCitations)::bigint n_cited, array_to_string(outCitations, ' ') cited from dl",
        "citing_publications": pb + "select id, len(outCitations)::bigint n_cited from dl where len(outCitations) > 0",
        "citations_exploded": pb + "select src, pos::bigint pos, cited from ex",
        "vertex_by_name": p + f"select v.name seed_name, v.id seed_id, v.in_deg, v.out_deg, v.pr from pg v "
                              f"where v.name in (select name from {_top('pg')} t)",
        "dense_publication_index": pb + "select id, (row_number() over (order by id) - 1)::bigint idx from pv",
        "dense_journal_index": jb + "select id, (row_number() over (order by id) - 1)::bigint idx from jv",
        "publication_edges": pb + "select src, dst from pe",
        "unresolved_citations": pb + "select src, pos::bigint pos, cited from ex where cited not in (select id from pv)",
        "publication_journal": c + "select id, min(journalName) journalName from pubs "
                                   "where coalesce(journalName, '') <> '' group by id",
        "journals": c + """select journalName, count(*) n_records, count(distinct id) n_publications,
       sum(len(outCitations))::bigint n_citations, min(id) min_id, max(id) max_id
from pubs where coalesce(journalName, '') <> '' group by journalName""",
        "publication_graph": p + "select id, name, in_deg, out_deg, pr from pg",
        "journal_graph": j + "select id, name, in_deg, out_deg, pr from jg",
        "graph_with_default": pb + """select x.id, coalesce(pv.name, 'nocitation') name
from (select src id from pe union select dst from pe) x left join pv on pv.id = x.id""",
        "journal_edges": jb + "select src, dst, n from je",
        "in_degrees": pb + "select dst id, count(*) in_deg from pe group by dst",
        "out_degrees": pb + "select src id, count(*) out_deg from pe group by src",
        "journal_in_degrees": jb + "select dst id, count(*) in_deg from je group by dst",
        "journal_out_degrees": jb + "select src id, count(*) out_deg from je group by src",
        "publication_summary": p + _summary("pg"),
        "journal_summary": j + _summary("jg"),
        "journal_rank_values": j + "select distinct pr from jg",
        "max_degree_vertices": p + _max_degree("pg"),
        "journal_max_degree_vertices": j + _max_degree("jg"),
        "publication_pagerank": p + "select id, pr from pg",
        "journal_pagerank": j + "select id, pr from jg",
        "neighbors_in": p + _neighbors("pe", seeds_p, "in"),
        "neighbors_out": p + _neighbors("pe", seeds_p, "out"),
        "neighbors_either": p + _neighbors("pe", seeds_p, "either"),
        "influential_publications": p.rstrip("\n") + _influential("pg", "pe"),
        "influential_journals": j.rstrip("\n") + _influential("jg", "je"),
        "top_publications": p + f"select * from {_top('pg')} t",
        "top_journals": j + f"select * from {_top('jg')} t",
        "influence_report_publications": p.rstrip("\n") + _report("pg", "pe"),
        "influence_report_csv": p.rstrip("\n") + _report("pg", "pe"),
        "influence_report_journals": j.rstrip("\n") + _report("jg", "je"),
        "graph_links": pb + """, idx as (select id, (row_number() over (order by id) - 1)::bigint idx from pv)
select a.idx source, b.idx target from pe join idx a on a.id = pe.src join idx b on b.id = pe.dst""",
        "hex_to_decimal": c + f"select id, {_hex('id')} id_dec, {_hex('md5(id)', 'uhugeint')} key_dec, "
                              f"{_hex('md5(id)', 'uhugeint')} key_fold from pubs",
        "stream_ingest_publications": c + f"""select id, title, journalName, len(outCitations)::bigint n_cited,
       array_to_string(outCitations, ' ') cited from pubs
where {_damage(TRUNCATE_EVERY)} <> 0 and {_damage(EMPTY_EVERY)} <> 0""",
    }
