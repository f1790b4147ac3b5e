"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowloom.llm import byte_pairs, chat, ctw, jaccard, langid, lines, merkle, mixing, naming, pieces, quality, secrets, spelling, sql_parts
from rowloom.llm.common import ascii_lower, documents, held_out
from rowloom.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from rowloom.session import small_table

_MARK = "<|im_end|><|im_start|>assistant ok"


@query(
    "op2_chat_formatting",
    f"""
    with rows as (
        select conv_id, turn, coalesce(role, '') as role, coalesce("text", '') as said from conversations
        union all select -1, 0, 'user', '{_MARK}' union all select -1, 1, 'assistant', '{_MARK}'),
    placed as (
        select *, row_number() over w - 1 as place, lag(role) over w as before from rows
        window w as (partition by conv_id order by turn nulls first, role, said)),
    moved as (
        select *, case
            when place = 0 then role in ('system', 'user')
            when role = 'user' then (before = 'system' and place = 1) or before = 'assistant'
            when role = 'assistant' then before = 'user' else false end as fits
        from placed)
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || said || chr(10), '' order by place)) as turns_sha256,
        coalesce(sum(length(said)) filter (role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(said, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
        sum(12 + length(url_encode(role)) + 1
            + length(replace(replace(said, '\\', '\\\\'), '<|', '<\\|')) + 11)::bigint as formatted_chars,
        bool_and(fits) and arg_max(role, place) = 'assistant' as valid,
        min(place) filter (not fits)::int as bad_turn
    from moved group by conv_id
    """,
)
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = small_table(spark, [(-1, 0, "user", _MARK), (-1, 1, "assistant", _MARK)], rows.schema.simpleString()[7:-1])
    return chat.digests(chat.read_back(chat.format_conversations(rows.union(extra))))


_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))


def _quality_check(rule: quality.Rule) -> str:
    whole = f"greatest({rule.denominator} - {rule.spare}, 0)"
    sides = [f"1000 * {rule.numerator} >= {rule.low} * {whole}"] * (rule.low is not None)
    sides += [f"1000 * {rule.numerator} <= {rule.high} * {whole}"] * (rule.high is not None)
    abstains = f" or 1000 * n_foreign > {quality.FOREIGN} * word_chars" if rule.listed else ""
    return f"({' and '.join(sides)}{abstains})"


_CHECKS = " and ".join(map(_quality_check, quality.RULES))


@query(
    "op3_quality_rules",
    rf"""
    with d as (
        select row_number() over () as r, doc_id, coalesce("text", '') as t,
            regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') as words,
            list_filter(string_split(coalesce("text", ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
        from documents),
    w as (select r, unnest(words) as word, generate_subscripts(words, 1) as place from d),
    five as (
        select r, place, case when lead(word, 4) over p is not null then
            concat_ws(' ', word, lead(word, 1) over p, lead(word, 2) over p, lead(word, 3) over p, lead(word, 4) over p) end as five
        from w window p as (partition by r order by place)),
    twice as (select *, five is not null and count(*) over (partition by r, five) > 1 as again from five),
    covered as (
        select r, bool_or(again) over (partition by r order by place rows between 4 preceding and current row) as hit from twice),
    repeated as (select r, count(*) filter (hit) as n from covered group by r),
    m as (
        select doc_id, len(words) as n_words, coalesce(length(array_to_string(words, '')), 0) as word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines,
            len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
            len(list_filter(words, lambda x: lower(x) in ({_STOP}))) as n_stop_words,
            len(list_filter(words, lambda x: suffix(x, '!!'))) as n_shouted,
            length(t) - length(regexp_replace(t, '{quality.foreign_letters()}', '', 'g')) as n_foreign
        from d left join repeated using (r)),
    v as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
    select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
        n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
        not base_failed and {_CHECKS} as kept
    from v
    """,
)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(quality.measures(documents(spark, folder), ["doc_id"]))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op4_entropy_balanced_mix")
def entropy_balanced_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


@query("op6_secret_scans")
def secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, folder))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


@query(
    "op7_block_naming",
    r"""
    with n as (
        select doc_id, length(coalesce("text", '')) as points,
            regexp_replace(coalesce("text", ''), '[\x20\x09-\x0D]+', '', 'g') as t from documents),
    r as (
        select doc_id, t, first(doc_id) over w as keep_id, row_number() over w = 1 as kept, count(*) over (partition by t) as group_size
        from n window w as (partition by t order by points desc, doc_id nulls last))
    select doc_id, keep_id, group_size, kept, sha256(t) as text_sha256 from r
    """,
)
def block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return naming.exact_duplicates(documents(spark, folder)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op8_piece_agenda")
def piece_agenda(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pieces.encode_documents(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_ngram_language")
def ngram_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(documents(spark, folder), held_out(F.col("doc_id"), 0))


_SHINGLES = r"""case when len(words) >= {k} then
        list_distinct(list_transform(range(1, len(words) - {k} + 2), lambda i: array_to_string(words[i:i + {k} - 1], ' ')))
        when len(words) > 0 then [array_to_string(words, ' ')] else [] end"""


@query(
    "op9_shingle_jaccard",
    rf"""
    with recursive d as (
        select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce("text", ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
    sets as (select r, doc_id, {_SHINGLES.format(k=jaccard.WORDS)} as s from d),
    items as (select r, len(s) as n, unnest(s) as item from sets),
    links as (
        select a.r as a, b.r as b from items a join items b on a.item = b.item and a.r <> b.r
        group by a.r, b.r, a.n, b.n having 100 * count(*) >= {jaccard.PERCENT} * (a.n + b.n - count(*))),
    reach as (select r, r as node from sets union select reach.r, links.b from reach join links on reach.node = links.a)
    select s.doc_id, len(s.s) as n_shingles, coalesce(min(o.doc_id), s.doc_id) as component_id
    from sets s join reach on s.r = reach.r join sets o on o.r = reach.node group by s.r, s.doc_id, s.s
    """,
)
def shingle_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components_of(documents(spark, folder)).select("doc_id", "n_shingles", "component_id")


@query("op1_context_tree_scores")
def context_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.score_documents(documents(spark, folder), held_out(F.col("doc_id"), 1))


@query(
    "op10_line_join",
    rf"""
    with d as (select row_number() over (order by doc_id nulls last) as r, doc_id, string_split(lower(coalesce("text", '')), chr(10)) as l from documents),
    x as (select r, doc_id, unnest(l) as line, generate_subscripts(l, 1) - 1 as line_no from d),
    w as (select row_number() over (order by r, line_no) as place, *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as words from x),
    sets as (select place, r, doc_id, line_no, {_SHINGLES.format(k=lines.WORDS)} as s from w),
    classes as (select list_sort(s) as c, min(place) as place from sets where len(s) > 0 group by c),
    items as (select place, len(c) as n, unnest(c) as item from classes),
    late as (
        select b.place from items a join items b on a.item = b.item and a.place < b.place
        group by a.place, b.place, a.n, b.n having 100 * count(*) >= {lines.PERCENT} * (a.n + b.n - count(*))),
    gone as (
        select s.r, s.line_no from sets s join classes c on list_sort(s.s) = c.c
        where s.place <> c.place or c.place in (select place from late))
    select s.doc_id, count(*) as n_lines, count(g.line_no) as n_removed,
        coalesce(string_agg(g.line_no::varchar, ',' order by g.line_no), '') as removed_lines
    from sets s left join gone g on s.r = g.r and s.line_no = g.line_no group by s.r, s.doc_id
    """,
)
def line_join(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.removals(lines.mark_lines(documents(spark, folder)))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


@query("op11_byte_pairs")
def byte_pair_codes(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return byte_pairs.encode_documents(
        documents(spark, folder), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def _merkle_leaf(text: str) -> str:
    cells = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in cells) + ")"


def _merkle_levels(name: str, levels: int) -> str:
    """{name}0 (t, i, d) to {name}{levels}, and g{name}0, ... with what stands beside each node."""
    out = []
    for k in range(levels):
        out.append(f"""
        {name}{k}c as (select *, count(*) over (partition by t) > 1 as more from {name}{k}),
        {name}{k + 1} as (
            select t, i // 16 as i, case when any_value(more) then sha256(string_agg(d, '' order by i)) else any_value(d) end as d
            from {name}{k}c group by t, i // 16),
        g{name}{k} as (
            select a.t, a.i, any_value(a.more) as more, coalesce(string_agg(b.d, '' order by b.i) filter (b.i < a.i), '') as l,
                coalesce(string_agg(b.d, '' order by b.i) filter (b.i > a.i), '') as r
            from {name}{k}c a join {name}{k}c b on a.t = b.t and a.i // 16 = b.i // 16 group by a.t, a.i)""")
    return ",".join(out)


def _merkle_folds(start: str, name: str, levels: int, tree: str, place: str) -> str:
    out = []
    for k in range(levels):
        out.append(f"""
        {start}{name}{k} as (
            select x.* exclude (f, p), p || l || r as p, case when more then sha256(l || f || r) else f end as f
            from {start if k == 0 else f'{start}{name}{k - 1}'} x join g{name}{k} g on x.{tree} = g.t and x.{place} // {16**k} = g.i)""")
    return ",".join(out)


#: Up to 16^5 rows per source and 16^3 sources.
_MERKLE_SQL = f"""
    with rows as (
        select doc_id, {_merkle_leaf('"text"')} as leaf, dense_rank() over (order by source nulls first) - 1 as t, 0 as o,
            case when {sql_parts.crc32(sql_parts.latin_bytes("doc_id::varchar"))} % 5 = 0
                then {_merkle_leaf(sql_parts.ascii_lower('"text"'))} end as tampered
        from documents),
    leaves as (select *, row_number() over (partition by t order by doc_id nulls last, leaf) - 1 as i from rows),
    a0 as (select t, i, leaf as d from leaves), {_merkle_levels("a", 5)},
    b0 as (select 0 as t, t as i, d from a5), {_merkle_levels("b", 3)},
    x as (select *, '' as p, coalesce(tampered, leaf) as f from leaves), {_merkle_folds("x", "a", 5, "t", "i")},
    y as (select * from xa4), {_merkle_folds("y", "b", 3, "o", "t")}
    select y.doc_id, leaf, a5.d as subroot, b3.d as root, sha256(p) as proof_sha256, f as folded_root, f = b3.d as verified
    from yb2 y join a5 on y.t = a5.t cross join b3
"""


@query("op13_merkle_manifest", _MERKLE_SQL)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in columns]
    # A null id has no remainder: nothing is changed there.
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf_of(changed))
    made = merkle.manifest(docs, columns, "source", "doc_id", carry={"tampered": tampered})
    leaf = merkle.spelled(F.col("digest"))
    fold = merkle.folded(F.coalesce(merkle.spelled(F.col("tampered")), leaf), F.col("proof"))
    rows = made.proven().select(
        F.col("order").alias("doc_id"),
        leaf.alias("leaf"),
        "subroot",
        F.lit(made.root).cast("string").alias("root"),
        F.sha2(merkle.spelled_proof(F.col("proof")), 256).alias("proof_sha256"),
        fold.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


_LATIN = "A-Za-zÀ-ÿ"


@query(
    "op12_spelling_variants",
    f"""
    with recursive runs as (
        select doc_id, unnest(list_transform(regexp_extract_all(coalesce("text", ''), '[{_LATIN}]+'),
            lambda r: {sql_parts.ascii_lower("r")})) as run from documents),
    hashed as (select run, {sql_parts.crc32(sql_parts.latin_bytes("coalesce(doc_id::varchar, '') || ':' || run"))} as h from runs where length(run) >= 7),
    results as (select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word from hashed),
    words as (select word, count(*) as n from results where length(word) >= 7 group by word having count(*) >= 2),
    holes as (
        select word, i, length(word) as size, substr(word, 1, i - 1) || substr(word, i + 1) as rest
        from (select word, unnest(range(1, length(word) + 1)) as i from words)),
    pairs as (
        select a.word as a, b.word as b from holes a join holes b on a.rest = b.rest and a.i = b.i and a.size = b.size and a.word <> b.word
        union select h.word, w.word from holes h join words w on h.rest = w.word
        union select w.word, h.word from holes h join words w on h.rest = w.word),
    best as (
        select a as word, count(*) as n_near, max(n) as most, min(b) filter (n = top) as form
        from (select p.*, w.n, max(w.n) over (partition by a) as top from pairs p join words w on p.b = w.word) group by a),
    told as (
        select w.word, w.n, case when most >= 10 * w.n then form end as form, coalesce(n_near, 0) as n_near,
            case when most >= 10 * w.n then most end as form_n
        from words w left join best using (word)),
    way as (
        select word, coalesce(form, word) as reached, 0 as steps from told
        union all select way.word, told.form, steps + 1 from way join told on way.reached = told.word where told.form is not null)
    select t.word, t.form, w.reached as root, t.n, t.n_near, t.form_n
    from told t join (select word, arg_max(reached, steps) as reached from way group by word) w using (word)
    """,
)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.count_words(documents(spark, folder))).select("word", "form", "root", "n", "n_near", "form_n")
