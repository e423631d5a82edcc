"""The registered queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe_lexicon, conversation_repair, hard_negatives, langid, line_rules, mixing, partenum, pii, quality_mil, secrets, sharding, toolcalls, topk_mih
from riskframe.llm.common import held_out, store


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    labels = _read(spark, sf, "labels").select("doc_id", "quality")
    model = quality_mil.train(docs.where(~held_out()).join(labels, "doc_id"))
    scored = quality_mil.score_quality(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out()))
    found = langid.identify(docs.drop("lang"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op2_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _read(spark, sf, "embeddings")
    return topk_mih.search(vectors, vectors.where("vec_id % 100 = 0"), TOP_K)


def vocabulary() -> bpe_lexicon.Vocabulary:
    """The vocabulary file stays in the package that brings it; the driver reads it."""
    import public_tokenizers

    return bpe_lexicon.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))


def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    words = vocabulary()
    lexicon = bpe_lexicon.build_lexicon(docs, words)
    decoded = bpe_lexicon.encode_and_decode_docs(docs, words, lexicon)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


TOP_K = 10

# Wanted shares of tokens per domain of ``labels``, the most uses of a kept domain's supply, and the
# domains that are kept whole; the shares of the others are upper limits.
MIX_WEIGHTS = {"good": 0.86, "low": 0.08, "toxic": 0.06}
MIX_REPEATS = 1.05
MIX_KEEP = ("good",)


def label_domain() -> Column:
    """The domain of a labelled row."""
    return F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").otherwise("good")


def mixing_model(docs: DataFrame, labels: DataFrame) -> mixing.DomainModel:
    domains = labels.where("quality is not null and toxic is not null").select("doc_id", label_domain().alias("domain"))
    return mixing.train(docs.select("doc_id", "text").join(domains, "doc_id"))


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    model = mixing_model(docs, _read(spark, sf, "labels"))
    rows = store(docs.select("doc_id", mixing.posteriors(model, F.col("text")).alias("m")).select("doc_id", "m.*"), "mix")
    mix = mixing.fit(rows, model.domains, MIX_WEIGHTS, MIX_REPEATS, keep=MIX_KEEP)
    p = [F.col("p")[j] for j in range(len(model.domains))]
    named = [c.alias(f"p_{d}") for c, d in zip(p, model.domains, strict=True)]
    fitted = [F.lit(float(v[d])).alias(f"{name}_{d}") for d in model.domains for name, v in (("target", mix.targets), ("total", mix.totals))]
    return rows.select("doc_id", "tokens", *named, mixing.rate_of(mix, p).alias("rate"), *fitted)


TOOL_SCHEMAS = {
    "calculate": {"mode": {"type": "string", "required": True}, "values": {"type": "array", "required": True}},
    "lookup": {"deep": {"type": "boolean", "required": True}, "key": {"type": "string", "required": True}},
    "search": {
        "limit": {"type": "integer", "required": True, "min": 1, "max": 15},
        "query": {"type": "string", "required": True},
    },
}

# Calls derived from user turns, in SQL that Spark and DuckDB read alike; ``_json`` quotes a string.
_TOOL = "case turn % 3 when 0 then 'search' when 1 then 'lookup' else 'calculate' end"
_ARGUMENTS = """
    case turn % 3
    when 0 then '{"query": ' || _json(text) || ', "limit": ' || cast(length(text) % 20 as string) || '}'
    when 1 then '{"key": "' || md5(text) || '"' || case when length(text) % 5 = 0 then '' else ', "deep": true' end || '}'
    else '{"values": [' || cast(length(text) as string) || ', 2.50], "mode": '
         || case when length(text) % 4 = 0 then '7' else '"sum"' end || '}'
    end
"""


def tool_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every user turn issues a call that depends on that of the user turn two before; an assistant
    turn is the result of the call one turn before."""
    quoted = "replace(replace(replace(text, '\\\\', '\\\\\\\\'), '\"', '\\\\\"'), '\\n', '\\\\n')"
    arguments = _ARGUMENTS.replace("_json(text)", "'\"' || " + quoted + " || '\"'")
    calls = messages.where("role = 'user'").selectExpr(
        "conv_id", "turn", "concat('c', conv_id, '-', turn) as call_id",
        "case when turn >= 2 then concat('c', conv_id, '-', turn - 2) end as parent_id",
        f"{_TOOL} as tool", f"{arguments} as arguments",
    )
    results = messages.where("role = 'assistant'").selectExpr("conv_id", "turn", "concat('c', conv_id, '-', turn - 1) as call_id")
    return calls, results


def op5_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    messages = _read(spark, sf, "conversations")
    calls, results = tool_calls(messages)
    return toolcalls.message_lines(messages, toolcalls.link_calls(calls, results, TOOL_SCHEMAS))


# Stands for a secret that a deployment takes from its own store.
PII_KEY = "riskframe-example-key"


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    return pii.pseudonymise_counted(docs, PII_KEY)


def op7_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_by_bytes(_read(spark, sf, "documents"))


def op9_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return partenum.jaccard_components(_read(spark, sf, "documents"))


def op10_line_rules(spark: SparkSession, sf: str) -> DataFrame:
    return line_rules.apply_rules(_read(spark, sf, "documents"))


def op11_secrets(spark: SparkSession, sf: str) -> DataFrame:
    spans = F.col("spans")
    found = secrets.find_secrets(_read(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.size(secrets.of_kinds(spans, k)).cast("bigint").alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(secrets.written(secrets.of_kinds(spans, *secrets.BASE)).cast("binary"), 256).alias("base_sha256"),
        secrets.written(spans).alias("spans"),
    )


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _read(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.valid_rows(vectors.withColumn("label", moved), "vec_id", "embedding", "label")
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_repair(spark: SparkSession, sf: str) -> DataFrame:
    messages = _read(spark, sf, "conversations")
    segments = conversation_repair.repaired_segments(conversation_repair.damage(messages))
    return conversation_repair.conversation_report(messages, segments)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_topk": op2_topk,
    "op3_bpe": op3_bpe,
    "op4_mixing": op4_mixing,
    "op5_tool_calls": op5_tool_calls,
    "op6_pii": op6_pii,
    "op7_shards": op7_shards,
    "op8_language": op8_language,
    "op9_jaccard": op9_jaccard,
    "op10_line_rules": op10_line_rules,
    "op11_secrets": op11_secrets,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_repair": op13_repair,
}
ORACLES = {
    "op12_hard_negatives": """
        with rows as materialized (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)
        ),
        scores as materialized (
            select a.vec_id as anchor_id, a.label as anchor_label, x.vec_id, x.label, cast(list_inner_product(a.q, x.q) as bigint) as score
            from rows a join rows x on a.vec_id % 100 = 0 and a.vec_id <> x.vec_id
        ),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scores where label = anchor_label
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        )
        select p.*, s.vec_id as negative_id, s.score as negative_score,
               cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as int) as rank
        from positives p join scores s on s.anchor_id = p.anchor_id and s.label <> s.anchor_label
            and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
        qualify rank <= 5
    """,
    "op13_repair": """
        with recursive
        crc_table as (
            select list_transform(range(256), lambda x: list_reduce(range(8), lambda c, k:
                case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, x)) as t
        ),
        keyed as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                   coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
            from conversations
        ),
        ways as (
            select k.* exclude (key), xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: cast(ascii(substr(key, i, 1)) as bigint)),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as way
            from keyed k, crc_table
        ),
        damaged as (
            select conv_id, turn, case when way = 4 then 'user' else role end as role,
                   case when way = 1 then '' when way = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
            from ways, range(2) c(copy) where way <> 0 and (copy = 0 or way = 3)
        ),
        numbered as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged
        ),
        placed as (
            select *, row_number() over (partition by conv_id, role, text order by i) as nth,
                   rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as ended, left(role, 1) as initial
            from numbered
        ),
        faults as (
            select *, case when ended = '' then 'blank' when nth > 1 then 'duplicate'
                           when right(ended, 1) in ('.', '!', '?') then '' else 'truncated' end as fault,
                   lag(initial) over (partition by conv_id order by i) as earlier
            from placed
        ),
        counts as (
            select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) as n,
                   count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
                   count(*) filter (fault = 'truncated') as truncated,
                   count(*) filter (i > 1 and earlier || initial not in ('su', 'ua', 'au')) as illegal
            from faults group by conv_id
        ),
        -- Least cost, edits and repaired text that lead to each state: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
        reached as (
            select conv_id, cast(0 as bigint) as i, [{'q': 0, 'cost': 0, 'audit': '', 'body': ''}, {'q': 2, 'cost': 2, 'audit': 'I', 'body': chr(10) || 'user:'},
                                 {'q': 3, 'cost': 4, 'audit': 'II', 'body': chr(10) || 'user:' || chr(10) || 'assistant:'}] as best from counts
            union all
            select conv_id, i, best from (
                with moved as (
                    select r.conv_id, f.i, unnest(list_concat(
                        [{'q': b.q, 'cost': b.cost + 3, 'audit': b.audit || 'D', 'body': b.body}],
                        case when f.fault in ('blank', 'duplicate') then [] else [
                            {'q': case when b.q = 2 then 3 else 2 end, 'cost': b.cost + 2 + extra, 'audit': b.audit || 'R',
                             'body': b.body || chr(10) || case when b.q = 2 then 'assistant:' else 'user:' end || f.text}] end,
                        case when f.fault in ('blank', 'duplicate') or next is null then [] else [
                            {'q': next, 'cost': b.cost + extra, 'audit': b.audit || 'K', 'body': b.body || chr(10) || f.role || ':' || f.text}] end
                        )) as s
                    from reached r join faults f on f.conv_id is not distinct from r.conv_id and f.i = r.i + 1,
                         unnest(r.best) u(b),
                         lateral (select case when f.fault = 'truncated' then 1 else 0 end as extra,
                             case when b.q = 0 and f.initial = 's' then 1 when b.q in (0, 1, 3) and f.initial = 'u' then 2
                                  when b.q = 2 and f.initial = 'a' then 3 end as next) l
                ),
                inserted as (
                    select conv_id, i, s from moved
                    union all
                    select conv_id, i, {'q': case when s.q = 2 then 3 else 2 end, 'cost': s.cost + 2, 'audit': s.audit || 'I',
                                        'body': s.body || chr(10) || case when s.q = 2 then 'assistant:' else 'user:' end} from moved
                    union all
                    select conv_id, i, {'q': case when s.q = 2 then 2 else 3 end, 'cost': s.cost + 4, 'audit': s.audit || 'II',
                                        'body': s.body || chr(10) || case when s.q = 2 then 'assistant:' || chr(10) || 'user:' else 'user:' || chr(10) || 'assistant:' end} from moved
                ),
                least as (
                    select conv_id, i, s.q as q, min({'cost': s.cost, 'audit': s.audit, 'body': s.body}) as m from inserted group by conv_id, i, s.q
                )
                select conv_id, i, list({'q': q, 'cost': m.cost, 'audit': m.audit, 'body': m.body}) as best from least group by conv_id, i
            )
        ),
        ends as (
            select r.conv_id, min({'cost': b.cost, 'audit': b.audit, 'body': substr(b.body, 2)}) as m
            from reached r join counts c on c.conv_id is not distinct from r.conv_id and c.n = r.i, unnest(r.best) u(b)
            where b.q in (0, 3) group by r.conv_id
        )
        select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
               coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(m.cost, 0) as bigint) as cost,
               coalesce(m.audit, '') as audit, sha256(coalesce(m.body, '')) as repaired_sha256
        from (select distinct conv_id from conversations) o
        left join counts c on c.conv_id is not distinct from o.conv_id
        left join ends e on e.conv_id is not distinct from o.conv_id
    """,
    "op5_tool_calls": f"""
        with recursive calls as (
            select conv_id, turn, min(text) as text, min({_TOOL}) as tool from conversations where role = 'user'
            group by conv_id, turn
        ),
        results as (select distinct conv_id, turn from conversations where role = 'assistant'),
        chain as (
            select conv_id, turn, 0 as depth from calls c
            where not exists (select 1 from calls p where p.conv_id = c.conv_id and p.turn = c.turn - 2)
            union all
            select c.conv_id, c.turn, p.depth + 1 from chain p join calls c on c.conv_id = p.conv_id and c.turn = p.turn + 2
        ),
        linked as (
            select c.*, d.depth, r.turn is not null as answered, length(text) as n,
                   concat('c', c.conv_id, '-', c.turn) as call_id,
                   case when c.turn >= 2 then concat('c', c.conv_id, '-', c.turn - 2) end as parent_id,
                   case c.turn % 3
                   when 0 then case when length(text) % 20 between 1 and 15 then '' else 'range:limit' end
                   when 1 then case when length(text) % 5 = 0 then 'missing:deep' else '' end
                   else case when length(text) % 4 = 0 then 'type:mode' else '' end end as error
            from calls c join chain d using (conv_id, turn) left join results r on r.conv_id = c.conv_id and r.turn = c.turn + 1
        ),
        checked as (
            select *, case when depth = 0 and parent_id is not null then 'parent' || case when error = '' then '' else ',' end
                      else '' end || error as errors
            from linked
        )
        select m.conv_id, m.turn, m.role, coalesce(c.call_id, a.call_id, o.call_id) as call_id,
               case when c.call_id is not null then case when c.answered then 'answered' else 'unanswered' end
                    when a.call_id is not null then 'answered' when o.call_id is not null then 'orphan' else 'plain' end as status,
               cast(coalesce(c.depth, a.depth) as int) as depth, c.errors,
               '{{' || case when coalesce(a.call_id, o.call_id) is null then '' else '"answers":"' || coalesce(a.call_id, o.call_id) || '",' end
               || case when c.call_id is null then '' else '"call":{{"arguments":' || case m.turn % 3
                    when 0 then '{{"limit":' || (c.n % 20) || ',"query":' || to_json(c.text) || '}}'
                    when 1 then '{{' || case when c.n % 5 = 0 then '' else '"deep":true,' end || '"key":"' || md5(c.text) || '"}}'
                    else '{{"mode":' || case when c.n % 4 = 0 then '7' else '"sum"' end || ',"values":[' || c.n || ',2.5]}}' end
                    || case when c.parent_id is null then '' else ',"depends_on":"' || c.parent_id || '"' end
                    || ',"id":"' || c.call_id || '","tool":"' || c.tool || '","valid":' || (c.errors = '') || '}},' end
               || '"content":' || to_json(m.text) || ',"role":"' || m.role || '","turn":' || m.turn || '}}' as line
        from conversations m
        left join checked c on m.role = 'user' and c.conv_id = m.conv_id and c.turn = m.turn
        left join checked a on m.role = 'assistant' and a.conv_id = m.conv_id and a.turn = m.turn - 1
        left join (select conv_id, turn, concat('c', conv_id, '-', turn - 1) as call_id from results) o
            on m.role = 'assistant' and a.call_id is null and o.conv_id = m.conv_id and o.turn = m.turn
    """,
    "op2_topk": f"""
        with codes as (
            select vec_id, list_transform(embedding, lambda x: case when x >= 0 then 1 else 0 end) as code from embeddings
        ),
        pairs as (
            select q.vec_id as query_id, c.vec_id as neighbor_id,
                   cast(list_sum(list_transform(list_zip(q.code, c.code), lambda p: abs(p[1] - p[2]))) as int) as distance
            from codes q join codes c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
        ),
        ranked as (
            select *, cast(row_number() over (partition by query_id order by distance, neighbor_id) as int) as rank from pairs
        )
        select query_id, rank, neighbor_id, distance from ranked where rank <= {TOP_K}
    """,
}
