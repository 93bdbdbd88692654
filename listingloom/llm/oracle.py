"""The queries in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

ORACLE = {
    "op1_chat_format": r"""
        with said as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all
            values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), escaped as (
            select *,
                regexp_replace(role, '([<\[])(~*)(/?s>|/?INST\]|image>|audio>|document>)', '\1~\2\3', 'g') as own_role,
                regexp_replace(text, '([<\[])(~*)(/?s>|/?INST\]|image>|audio>|document>)', '\1~\2\3', 'g') as own_text
            from said
        )
        select conv_id,
            count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, own_role, own_text))
                as turns_sha256,
            coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn nulls first, own_role, own_text)
                filter (role = 'assistant'), '')) as loss_sha256,
            sum(length('<s>[INST][/INST]</s>') + length(own_role) + length(own_text))::bigint as formatted_chars
        from escaped group by conv_id
    """,
    "op3_source_mix": r"""
        with sized as (
            select doc_id, source,
                coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
            from documents
        ), per_source as (
            select source, sum(size)::bigint as source_size,
                [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
            from sized group by source
        ), stops as (
            select *, source_size * 3 as most, (source_size * 3)::double / weight as stop from per_source
        ), shares as (
            select *,
                (sum(source_size) over () - coalesce(sum(most) over before, 0))::double
                    / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double as share
            from stops
            window before as (order by stop, source nulls last rows between unbounded preceding and 1 preceding)
        ), targets as (
            select source, source_size,
                coalesce(least((select arg_min(share, stop) from shares where share <= stop) * weight, most::double), 0.0)
                    as target
            from shares
        ), due as (
            select doc_id, s.source, size, source_size, target,
                floor(case when source_size > 0 then target / source_size else 0 end) as whole,
                case when source_size > 0 then target / source_size else 0 end as copies,
                ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint
                    / 4503599627370496.0::double as u
            from sized s join targets t on s.source is not distinct from t.source
        ), ranked as (
            select *, target - whole * source_size as need,
                case when copies - whole > 0
                    then (u / (1 - u)) / (least(copies - whole, 1 - 1e-12) / (1 - least(copies - whole, 1 - 1e-12)))
                    else 'infinity'::double end as rank
            from due
        ), placed as (
            select *, coalesce(sum(size) over (
                partition by source order by rank, doc_id nulls first, size
                rows between unbounded preceding and 1 preceding), 0) as before
            from ranked
        )
        select doc_id, size, source_size, target,
            (size * (whole + case when need > 0 and (need - before) * 2 >= size then 1 else 0 end))::bigint as taken
        from placed
    """,
    "op8_ball_tree_top_k": r"""
        with vectors as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as vector
            from embeddings
            where embedding is not null
                and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
        ), scored as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.vector, c.vector)::bigint as score
            from vectors q join vectors c on q.vec_id <> c.vec_id
            where q.vec_id % 20 = 0
        ), ranked as (
            select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
                vec_id, score
            from scored
        )
        select * from ranked where rank <= 20
    """,
    "op11_benchmark_winnowing": r"""
        with docs as (
            select row_number() over () as row, doc_id,
                regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
            from documents
        ), items as (
            select coalesce(item_id::varchar, '') as item_id,
                regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
            from benchmark
        ), lengths as (
            select distinct least(len(words), 10) as size from items where len(words) > 0
        ), item_windows as (
            select distinct item_id, array_to_string(words[i : i + size - 1], ' ') as said
            from (select item_id, words, least(len(words), 10) as size,
                    unnest(range(1, len(words) - least(len(words), 10) + 2)) as i
                from items where len(words) > 0)
        ), doc_windows as (
            select row, i, size, array_to_string(words[i : i + size - 1], ' ') as said
            from (select row, words, size, unnest(range(1, len(words) - size + 2)) as i
                from docs, lengths where len(words) >= size)
        ), hits as (
            select row, i, size, item_id from doc_windows join item_windows using (said)
        ), hit_words as (
            select row, count(distinct place) as n_hit
            from (select row, unnest(range(i, i + size)) as place from (select distinct row, i, size from hits)) group by row
        ), hit_items as (
            select row, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids
            from hits group by row
        )
        select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
            coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
            n_hit is not null as contaminated
        from docs left join hit_words using (row) left join hit_items using (row)
    """,
    "op12_filter_interaction": r"""
        with said as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
            from documents
        ), flags as (
            select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
        ), failing as (
            select part,
                [len(words) < 200,
                 100 * len(list_distinct(words)) < 50 * len(words),
                 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
                 regexp_matches(text, '[#$%&*|]'),
                 coalesce(s.doc_id > min(s.doc_id) over (partition by text), false)] as fails,
                coalesce(good, false) as good, coalesce(toxic, false) as toxic
            from said s left join flags f on s.doc_id = f.doc_id
        ), counts as (
            select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
            from failing group by all
        ), letters as (
            select unnest(range(1, 6)) as f
        ), orders as (
            select [a.f, b.f, c.f, d.f, e.f] as o
            from letters a, letters b, letters c, letters d, letters e
            where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
        ), steps as (
            select o, step, o[1 : step - 1] as before, o[step] as f from orders, (select unnest(range(1, 6)) as step)
        ), judged as (
            select part, o, step, f, n, good, toxic, fails[f] as failed,
                len(list_filter(before, lambda x: fails[x])) > 0 as gone,
                len(list_filter(fails, lambda x: x)) = 1 as alone
            from counts, steps
        ), summed as (
            select part, o, step, f,
                coalesce(sum(n) filter (not gone and not failed), 0)::bigint as kept,
                coalesce(sum(n) filter (not gone and failed), 0)::bigint as removed,
                coalesce(sum(n) filter (gone and failed), 0)::bigint as redundant,
                coalesce(sum(n) filter (failed and alone), 0)::bigint as unique_fails,
                coalesce(sum(good) filter (not gone and failed), 0)::bigint as good_lost,
                coalesce(sum(toxic) filter (not gone and failed), 0)::bigint as toxic_lost
            from judged group by all
        )
        select part, array_to_string(list_transform(o, lambda x: chr((64 + x)::int)), '') as filter_order,
            step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) over (partition by part, f))::bigint as shapley
        from summed
    """,
    "op13_source_divergence": r"""
        with said as (
            select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
            from documents
        ), counted as (
            select row, lang, source, term, count(*) as n
            from (select row, lang, source, unnest(terms) as term from said) group by all
        ), kept as (
            select lang, term, sum(n)::bigint as total from counted group by all having count(*) >= 3
        ), per_source as (
            select lang, source, term, sum(n)::bigint as n from counted semi join kept using (lang, term) group by all
        ), lang_sizes as (
            select lang, count(*) as v, sum(total)::bigint as size from kept group by all
        ), sizes as (
            select g.lang, g.source, coalesce(sum(n), 0)::bigint as size
            from (select distinct lang, source from said) g left join per_source using (lang, source) group by all
        ), shares as (
            select g.lang, g.source, k.term, coalesce(n, 0) as n,
                1 + 1000000000 * (coalesce(n, 0) + 1) // (g.size + v) as p,
                1 + 1000000000 * (total + 1) // (l.size + v) as whole
            from sizes g join kept k on g.lang = k.lang join lang_sizes l on g.lang = l.lang
            left join per_source s on s.lang = g.lang and s.source = g.source and s.term = k.term
        ), pairs as (
            select a.lang, a.source, 'pair' as part, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
            union all
            select a.lang, a.source, 'pair', b.source, 0::bigint
            from sizes a join sizes b on a.lang = b.lang and a.source <> b.source
            where a.lang not in (select lang from kept)
        ), terms as (
            select lang, source, 'term' as part, term as item, ((p - whole) * (p - whole) // whole)::bigint as value
            from shares where n > 0 and p > whole
        ), ranked as (
            select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
            from (select * from pairs union all select * from terms)
        )
        select * from ranked where part = 'pair' or rank <= 200
    """,
}
