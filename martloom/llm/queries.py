"""One query per operator over the test tables, as its contract fixes it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    conversations,
    exact_dedup,
    language,
    near_dedup,
    neighbours,
    packing,
    pii,
    quality,
    ranked_search,
    sentencepiece_codec,
    topk,
    toxicity,
    url_filters,
)
from martloom.llm.common import documents, fold

Query = Callable[[SparkSession, str], DataFrame]


def _labelled(spark: SparkSession, folder: str, label: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    return documents(spark, folder).select("doc_id", "text").join(labels, "doc_id")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = language.fit_languages(docs.filter(fold("doc_id", 5) != 0))
    found = language.detect_languages(docs, model)
    return found.withColumn("held_out", fold("doc_id", 5) == 0)


def op2_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return topk.exact_top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    rows = _labelled(spark, folder, "toxic").filter(fold("doc_id", 5) != 0)
    found = toxicity.score_toxicity(documents(spark, folder), toxicity.fit_toxicity(rows))
    return found.selectExpr(
        "doc_id", "score", "cast(score >= 0.5 as int) as predicted", "toxic_windows", "windows"
    ).withColumn("held_out", fold("doc_id", 5) == 0)


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.with_spans(documents(spark, folder).select("doc_id", "text"))
    base = F.filter("pii_spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[
            F.expr(f"cast(size(filter(pii_spans, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
            for kind in pii.BASE_KINDS
        ],
        F.sha2(pii.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(F.col("pii_spans")).alias("spans"),
        # Confidence in each span in hundredths, words on both sides of it considered.
        F.array_join(F.transform("pii_spans", lambda s: F.round(100 * s["score"]).cast("int")), ",").alias("scores"),
    )


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, folder), words=4)


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder), keep="largest")


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(documents(spark, folder), vocabulary, keep_ids=False)


# The pages have no fetch days and come without lists, so both are derived from them: days from the
# page's number, and entries from the hosts and paths that occur, by two digits of an MD5.
FIRST_DAY = "2024-01-01"


def _digit(text: str, at: int) -> str:
    return f"(ascii(substr(md5({text}), {at}, 1)) * 7 + ascii(substr(md5({text}), {at + 1}, 1)) * 31)"


# kind, pattern over (host, domain, section), how often (one in n), then (action, days after the first) in turn.
LISTS = (
    ("host", "host", 3, (("block", 0), ("remove", 60), ("block", 120))),
    ("domain", "domain", 4, (("block", 0), ("allow", 90), ("allow", 90))),
    ("prefix", "host || '/' || section", 5, (("allow", 0), ("block", 200), ("remove", 200))),
)


def _entries(pages: DataFrame) -> DataFrame:
    """Log of list entries for hosts, their domains, and sections of hosts."""
    host = url_filters.host_of(F.col("url"))
    named = pages.select(host.alias("host"), F.get(url_filters.segments_of(F.col("url")), F.lit(0)).alias("section"))
    named = named.filter("host is not null").distinct()
    named = named.withColumn("domain", F.substring_index("host", ".", -3))
    listed = [
        f"struct('{kind}' as kind, {pattern} as pattern, {one_in} as one_in, "
        f"array({', '.join(f"struct('{action}' as action, {days} as days)" for action, days in steps)}) as steps)"
        for kind, pattern, one_in, steps in LISTS
    ]
    patterns = named.selectExpr(f"inline(array({', '.join(listed)}))").filter("pattern is not null").distinct()
    chosen = patterns.filter(f"{_digit('pattern', 1)} % one_in = 0").selectExpr("kind", "pattern", "inline(steps)")
    day = f"date_add(date '{FIRST_DAY}', {_digit('pattern', 3)} % 200 + days) as day"
    return chosen.selectExpr("kind", "pattern", "action", day)


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    fetched = F.expr(f"date_add(date '{FIRST_DAY}', cast(page_id % 366 as int))")
    return url_filters.filter_urls(pages.withColumn("fetched", fetched), _entries(pages))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = _labelled(spark, folder, "quality").filter(fold("doc_id", 4) != 2)
    found = quality.score_quality(documents(spark, folder), quality.fit_quality(rows))
    return found.selectExpr("doc_id", "score", "cast(score >= 0.7 as int) as predicted").withColumn(
        "held_out", fold("doc_id", 4) == 2
    )


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = sentencepiece_codec.encode_decode(documents(spark, folder), model)
    return found.selectExpr(
        "doc_id",
        "cast(size(ids) as bigint) as n_tokens",
        "sha2(cast(array_join(ids, ',') as binary), 256) as ids_sha256",
        "sha2(cast(decoded as binary), 256) as decoded_sha256",
    )


def _damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that their numbers and turns choose."""
    texts = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    chosen = F.crc32(key.cast("binary")) % 20
    rows = rows.select("conv_id", "turn", *[c.alias(n) for n, c in texts.items()], chosen.alias("chosen"))
    text = F.when(F.col("chosen") == 1, "").when(
        F.col("chosen") == 2, F.regexp_replace("text", "[.!?]", "")
    )
    return rows.filter("chosen <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("chosen") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("chosen") == 3, 2).otherwise(1))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    report, pieces = conversations.repair_conversations(_damaged(rows))
    line = "array_join(transform(rows, r -> concat(r.role, ':', r.text)), '\n')"
    lines = pieces.filter("size(rows) > 0").selectExpr("conv_id", f"struct(place, {line} as line) as lines")
    given = rows.select("conv_id").unionByName(report, allowMissingColumns=True)
    given = given.unionByName(lines, allowMissingColumns=True).groupBy("conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return given.agg(
        *[F.coalesce(F.max(name), F.lit(0)).alias(name) for name in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.array_join(F.sort_array(F.collect_list("lines"))["line"], "\n").alias("repaired"),
    ).select("conv_id", *counts, "audit", F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))


def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return neighbours.nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked_search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), k=20)


def llm_queries() -> dict[str, Query]:
    queries = {
        run.__name__: run
        for run in (
            op1_language_id,
            op2_exact_topk,
            op3_toxicity,
            op4_pii,
            op5_near_dedup,
            op6_exact_dedup,
            op7_best_fit_packing,
            op8_url_filters,
            op9_quality,
            op10_sentencepiece,
            op11_conversation_repair,
            op12_nearest_neighbours,
            op13_ranked_search,
        )
    }
    return queries | {"pipeline": corpus_pipeline.run}


def llm_sql() -> dict[str, str]:
    """SQL twins of the queries that SQL can express."""
    return {
        "op2_exact_topk": OP2_SQL,
        "op4_pii": OP4_SQL,
        "op6_exact_dedup": OP6_SQL,
        "op8_url_filters": OP8_SQL,
        "op11_conversation_repair": OP11_SQL,
        "op13_ranked_search": OP13_SQL,
    }


_WEB = r"^[hH][tT][tT][pP][sS]?://(?:[^/?#@]*@)?(?:\[([0-9A-Fa-f:.]+)\]|([^/?#:@\[][^/?#:@]*))(?::[0-9]*)?([^?#]*)"
_HOST = f"regexp_replace(lower(regexp_extract(url, '{_WEB}', 1) || regexp_extract(url, '{_WEB}', 2)), '\\.$', '')"
_LOGS = " union all ".join(
    f"""select {url_filters.KINDS.index(kind)} as kind, pattern, {url_filters.ACTIONS.index(action)} as effect,
        date '{FIRST_DAY}' + cast({_digit('pattern', 3)} % 200 + {days} as int) as day
    from (select distinct {pattern} as pattern from named) where {_digit('pattern', 1)} % {one_in} = 0"""
    for kind, pattern, one_in, steps in LISTS
    for action, days in steps
)
OP8_SQL = f"""
with parts as (
    select page_id, url, date '{FIRST_DAY}' + cast(page_id % 366 as int) as fetched,
        nullif({_HOST}, '') as host,
        list_filter(string_split(regexp_extract(url, '{_WEB}', 3), '/'), lambda s: s <> '') as segments
    from pages
),
captures as (select * replace (if(length(host) <= 253, host, null) as host) from parts),
named as (
    select host, segments[1] as section,
        array_to_string(string_split(host, '.')[-3:], '.') as domain
    from captures where host is not null
),
log as (select kind, pattern, day, max(effect) as effect from ({_LOGS}) where pattern is not null group by all),
keys as (
    select page_id, url, fetched, 0 as kind, n as parts, array_to_string(string_split(host, '.')[-n:], '.') as pattern
    from captures, unnest(range(least(2, len(string_split(host, '.'))), len(string_split(host, '.')) + 1)) as t(n)
    where host is not null
    union all
    select page_id, url, fetched, 1, len(string_split(host, '.')), host from captures where host is not null
    union all
    select page_id, url, fetched, 2, n, host || '/' || array_to_string(segments[1:n], '/')
    from captures, unnest(range(1, least(3, len(segments)) + 1)) as t(n)
    where host is not null
),
active as (
    select k.page_id, k.url, k.fetched, k.kind, k.parts, k.pattern, l.effect, l.day
    from keys k asof join log l on k.kind = l.kind and k.pattern = l.pattern and k.fetched >= l.day
),
decided as (
    select page_id, url, fetched, max({{'kind': kind, 'parts': parts, 'effect': effect, 'pattern': pattern, 'day': day}}) as rule
    from active where effect > 0 group by all
)
select c.page_id, c.url, cast(c.fetched as date) as fetched, c.host,
    case when c.host is null then 'invalid' when d.rule is null then 'unlisted'
        when d.rule.effect = 2 then 'allowed' else 'blocked' end as verdict,
    (['domain', 'host', 'prefix'])[d.rule.kind + 1] as rule_kind,
    d.rule.pattern as rule_pattern, cast(d.rule.day as date) as rule_since
from captures c left join decided d using (page_id, url, fetched)
"""


OP2_SQL = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
),
scores as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 20 = 0
),
ranked as (
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank,
        vec_id, score
    from scores
)
select * from ranked where rank <= 20
"""


_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_REVERSED = f"string_split(reverse({_DIGITS}), '')"
_LUHN = (
    f"list_sum(list_transform({_REVERSED}, lambda c, i: case when i % 2 = 1 then cast(c as int)"
    " when cast(c as int) > 4 then 2 * cast(c as int) - 9 else 2 * cast(c as int) end)) % 10 = 0"
)
_PLAIN = "regexp_replace(hit, '[^A-Z0-9]', '', 'g')"
_TURNED = f"string_split(concat(substr({_PLAIN}, 5), left({_PLAIN}, 4)), '')"
_MOD97 = (
    f"list_reduce(list_prepend(0, list_transform({_TURNED}, lambda c: case when c between '0' and '9'"
    " then ascii(c) - 48 else ascii(c) - 55 end)),"
    " lambda a, x: (a * (case when x > 9 then 100 else 10 end) + x) % 97) = 1"
)
# Spaced account numbers that end where their country says. There is no look-ahead here: a number may
# not run into a small letter either, and a longer match may run over the beginning of another number.
_COUNTRIES = "|".join(
    rf"({countries.replace(' ', '|')})[0-9]{{2}}(\x20[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
    + (rf"\x20[A-Z0-9]{{{(n - 4) % 4}}}" if n % 4 else "")
    + r"\b"
    for n, countries in pii.IBAN_LENGTHS.items()
)
# kind, pattern as stated, and what confirms a match.
_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    (
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "list_max(list_transform(string_split(hit, '.'), lambda p: cast(p as hugeint))) <= 255",
    ),
    ("card", r"[0-9]([\x20-]?[0-9])+", f"case when length({_DIGITS}) between 16 and 19 then {_LUHN} else false end"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 8 and 15"),
    (
        "iban",
        _COUNTRIES + r"|[A-Z]{2}[0-9]{2}([A-Z0-9]{11,30}|(\x20[A-Z0-9]{4}){2,7}(\x20[A-Z0-9]{1,3})?)",
        _MOD97,
    ),
)


def _confidence(kind: str) -> int:
    return round(100 * next(k.confidence for k in pii.KINDS if k.name == kind))


def _context(kind: str) -> str:
    return next(k.context for k in pii.KINDS if k.name == kind)


_HITS = " union all ".join(
    f"""select doc_id, {n} as place, '{kind}' as kind, unnest(hits) as hit,
        unnest(list_transform(hits, lambda h, i: list_sum(list_transform(gaps[1:i], lambda g: length(g)))
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0))) as start,
        unnest(list_transform(hits, lambda h, i: {_confidence(kind)} + if(
            regexp_matches(lower(right(gaps[i], {pii.CONTEXT})), '{_context(kind)}')
            or regexp_matches(lower(left(gaps[i + 1], {pii.CONTEXT})), '{_context(kind)}'),
            {round(100 * pii.CONTEXT_BONUS)}, 0))) as score
    from (select doc_id, regexp_extract_all(t, '{pattern}') as hits, string_split_regex(t, '{pattern}') as gaps
        from texts where regexp_matches(t, '{pattern}'))"""
    for n, (kind, pattern, _) in enumerate(_KINDS)
)
_CONFIRMED = " ".join(f"when kind = '{kind}' then {test}" for kind, _, test in _KINDS)
OP4_SQL = f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
hits as ({_HITS}),
spans as (
    select doc_id, place, kind, start, score,
        concat(kind, ':', cast(start as bigint), ':', cast(start + length(hit) as bigint)) as span
    from hits where case {_CONFIRMED} end
)
select texts.doc_id,
    count(*) filter (kind = 'email') as n_email,
    count(*) filter (kind = 'ip') as n_ip,
    count(*) filter (kind = 'card') as n_card,
    count(*) filter (kind = 'phone') as n_phone,
    sha256(coalesce(string_agg(span, ',' order by place, start) filter (kind <> 'iban'), '')) as base_sha256,
    coalesce(string_agg(span, ',' order by place, start) filter (span is not null), '') as spans,
    coalesce(string_agg(cast(score as varchar), ',' order by place, start) filter (span is not null), '') as scores
from texts left join spans on spans.doc_id = texts.doc_id
group by texts.doc_id
"""


OP6_SQL = """
select doc_id,
       max(doc_id) over same as keep_id,
       count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""


# The CRC-32 of a text of ASCII characters, bit by bit.
def _crc32(text: str) -> str:
    bit = "lambda c, k: xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end)"
    byte = f"lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], {bit}, xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda x: cast(ascii(x) as bigint))"
    return f"xor(list_reduce({codes}, {byte}, cast(4294967295 as bigint)), 4294967295)"


# Cheapest edits up to a row, by state, from those up to the row before: a plain shortest path.
def _step() -> str:
    def entry(state: int, cost: str, edit: str) -> str:
        return f"{{'cost': v[{state + 1}].cost + {cost}, 'audit': v[{state + 1}].audit || '{edit}'}}"

    left = "(case when s.late then 5 else 0 end)"
    follows = {1: (0,), 2: (0, 1, 3), 3: (2,)}
    cells = []
    for state in range(4):
        ways = [entry(state, "2", "D")]
        for before in follows.get(state, ()):
            role = " sua"[state]
            ways.append(entry(before, f"case when s.sign = '{role}' then {left} else 1000000000 end", "K"))
            if role != "s":
                ways.append(entry(before, f"case when s.sign = 'x' then 1000000000 else 1 + {left} end", "R"))
        cells.append(f"list_min([{', '.join(ways)}])")
    return f"[{', '.join(cells)}]"


def _insert(state: int) -> str:
    """Cells after inserting in front of the state, none or once."""
    follows = {2: (0, 1, 3), 3: (2,)}[state]
    ways = [f"v[{state + 1}]"] + [f"{{'cost': v[{b + 1}].cost + 5, 'audit': v[{b + 1}].audit || 'I'}}" for b in follows]
    cells = [f"list_min([{', '.join(ways)}])" if q == state else f"v[{q + 1}]" for q in range(4)]
    return f"[{', '.join(cells)}]"


_STATES = "{'cost': cast(%s as bigint), 'audit': '%s'}"
_BEGIN = ", ".join(_STATES % x for x in ((0, ""), (1000000000, ""), (5, "I"), (10, "II")))
OP11_SQL = f"""
with recursive chosen as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        {_crc32("concat(coalesce(cast(conv_id as varchar), ' '), ':', coalesce(cast(turn as varchar), ' '))")} % 20 as h
    from conversations
),
damaged as (
    select conv_id, turn, case when h = 4 then 'user' else role end as role,
        case when h = 1 then '' when h = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from chosen, (values (1), (2)) as copies(copy)
    where h <> 0 and (copy = 1 or h = 3)
),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as place,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as ending
    from damaged
),
judged as (
    select *, case when ending = '' then 'b'
            when row_number() over (partition by conv_id, role, text order by place) > 1 then 'd'
            when ending not in ('.', '!', '?') then 't' else '' end as fault,
        lag(left(role, 1)) over (partition by conv_id order by place) || left(role, 1) as pair
    from placed
),
counted as (
    select conv_id, max(place) as many,
        coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
        count(*) filter (fault = 't') as truncated,
        count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
    from judged group by conv_id
),
paths as (
    select conv_id, cast(0 as bigint) as place, [{_BEGIN}] as v from counted
    union all
    select conv_id, place, {_insert(3)} from (
        select conv_id, place, {_insert(2)} as v from (
            select p.conv_id, s.place, {_step()} as v
            from paths p join (
                select conv_id, place, fault = 't' as late,
                    case when fault in ('b', 'd') then 'x' when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'o' end as sign
                from judged
            ) s on s.conv_id is not distinct from p.conv_id and s.place = p.place + 1))
),
cheapest as (
    select c.*, list_min([p.v[1], p.v[4]]) as best
    from counted c join paths p on c.conv_id is not distinct from p.conv_id and c.many = p.place
),
edits as (
    select conv_id, best.audit as audit, unnest(string_split(best.audit, '')) as edit,
        unnest(range(1, length(best.audit) + 1)) as i
    from cheapest
),
numbered as (
    select *, sum(cast(edit <> 'I' as int)) over w as place, sum(cast(edit <> 'D' as int)) over w as kept,
        length(replace(audit, 'D', '')) % 2 as system
    from edits window w as (partition by conv_id order by i rows unbounded preceding)
),
lines as (
    select n.conv_id, n.i,
        case when edit = 'K' then j.role when (kept + system) % 2 = 1 then 'user' else 'assistant' end
        || ':' || case when edit = 'I' then '' else j.text end as line
    from numbered n left join judged j on n.conv_id is not distinct from j.conv_id and n.place = j.place
    where edit <> 'D'
),
repaired as (select conv_id, string_agg(line, chr(10) order by i) as whole from lines group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost,
    coalesce(best.audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
    left join cheapest c on o.conv_id is not distinct from c.conv_id
    left join repaired r on o.conv_id is not distinct from r.conv_id
"""


def _words(table: str, key: str) -> str:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = f"translate(text, '{capitals}', '{capitals.lower()}')"
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    words = f"select {key}, unnest(regexp_extract_all({text}, '{pattern}')) as term from {table}"
    return f"select {key}, term, count(*) as times from ({words}) group by all"


OP13_SQL = f"""
with held as ({_words("documents", "doc_id")}),
asked as ({_words("benchmark", "item_id")}),
lengths as (select doc_id, cast(sum(times) as bigint) as n from held group by doc_id),
whole as (select count(*) as docs, cast(sum(n) as bigint) as terms from lengths),
sized as (select doc_id, 75 + (25 * n * docs) // terms as m from lengths, whole),
weighed as (
    select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w
    from held, whole group by term, docs
),
scored as (
    select item_id, doc_id,
        cast(sum(a.times * w * ((1000000000 * h.times) // (1000 * h.times + 12 * m))) as bigint) as score
    from asked a join held h using (term) join sized using (doc_id) join weighed using (term)
    group by item_id, doc_id
),
ranked as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
    from scored where score > 0
)
select * from ranked where rank <= 20
"""
