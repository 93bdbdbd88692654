"""The queries of the query book in SQL, written independently of the operators."""

from __future__ import annotations

RUN_TS = "2024-06-01 00:00:00"


def mean(value: str) -> str:
    return f"cast(cast(round(cast(avg({value}) as decimal(38,10)), 2) as decimal(18,2)) as double)"


def percent(part: str, whole: str) -> str:
    ratio = f"cast({part} as double) * 100 / nullif({whole}, 0)"
    return f"cast(cast(round(cast({ratio} as decimal(38,10)), 2) as decimal(18,2)) as double)"


def key(name: str) -> str:
    """Normalized product name, step by step."""
    x = f"lower(trim(coalesce({name}, '')))"
    x = f"regexp_replace({x}, '\\(.*?\\)', ' ', 'g')"
    x = f"regexp_replace({x}, '\\[.*?\\]', ' ', 'g')"
    for phrase in (
        "tái bản", "bìa mềm", "bìa cứng", "phiên bản đặc biệt", "ấn bản đặc biệt",
        "tặng kèm", "kèm bookmark", "kèm quà tặng", "khổ lớn",
    ):
        x = f"replace({x}, '{phrase}', ' ')"
    x = f"regexp_replace({x}, '[^0-9A-Za-zÀ-ỹ\\s]', ' ', 'g')"
    x = f"regexp_replace({x}, '\\s+', ' ', 'g')"
    return f"nullif(trim({x}), '')"


BASES = """
products as (
    select p_partkey as product_id, p_name as product_name,
           'https://shop.example/p/' || p_partkey as product_url,
           'https://shop.example/i/' || p_partkey as image_src from part),
categories as (select n_nationkey as category_id, n_name as category_name from nation),
product_category_map as (
    select distinct l_partkey as product_id, s_nationkey as category_id
    from lineitem join supplier on l_suppkey = s_suppkey),
product_snapshot as (
    select l_partkey as product_id, l_shipdate as processed_time,
           cast(l_extendedprice as decimal(18,2)) as price,
           cast(l_extendedprice as decimal(18,2)) * cast(1 - l_discount as decimal(4,2)) as final_price,
           cast(l_discount * 100 as decimal(6,2)) as discount_percent,
           l_linestatus = 'O' as stock_available, cast(l_quantity as bigint) as sold_qty,
           l_orderkey, l_linenumber, l_suppkey, l_extendedprice
    from lineitem),
pipeline_runs as (
    select o_orderkey as process_run_id, o_orderdate as processed_at, o_orderpriority as source_name,
           'raw/' || o_orderkey as raw_file_minio, o_custkey as total_raw_records from orders),
data_quality_reports as (
    select l_orderkey as process_run_id, count(*) as total_products_seen,
           count(*) filter (l_returnflag <> 'R') as products_passed,
           count(*) filter (l_returnflag = 'R') as products_failed,
           count(*) filter (l_linenumber = 1) as missing_product_id,
           count(*) filter (l_linenumber = 2) as missing_product_name,
           count(*) filter (l_linenumber = 3) as missing_product_url,
           count(*) filter (l_discount = 0) as invalid_price_negative,
           count(*) filter (l_tax = 0) as invalid_final_price_negative,
           count(*) filter (l_linestatus = 'O') as final_price_greater_than_price,
           count(*) filter (l_quantity > 25) as duplicate_product_id
    from lineitem group by 1),
rejected_products as (select l_shipdate as rejected_at from lineitem where l_returnflag = 'R'),
pipeline_task_audit as (
    select l_shipdate as finished_at,
           case when l_linestatus = 'F' then 'success' else 'failed' end as status from lineitem),
latest_product_snapshot as (
    select product_id, product_name, product_url, image_src, price, final_price,
           discount_percent, stock_available, sold_qty, processed_time
    from products join product_snapshot using (product_id)
    qualify row_number() over (partition by product_id order by processed_time desc,
            l_orderkey, l_linenumber, l_suppkey, l_extendedprice) = 1),
all_ties as (
    select * from product_snapshot where processed_time is not null
    qualify rank() over (partition by product_id order by processed_time desc) = 1)
"""

ACCOUNTS = """
accounts as (
    select 'customer' as source_name, cast(c_custkey as varchar) as product_id,
           case when c_custkey % 7 <> 0 then c_name else '  ' end as product_name,
           cast(round(c_acctbal) as bigint) as price, c_nationkey as process_run_id,
           case when c_custkey % 5 <> 0 then '/a/' || c_custkey end as product_url
    from customer
    union all
    select 'supplier', cast(s_suppkey as varchar),
           case when s_suppkey % 7 <> 0 then s_name else '  ' end,
           cast(round(s_acctbal) as bigint), s_nationkey,
           case when s_suppkey % 5 <> 0 then '/a/' || s_suppkey end
    from supplier),
checked as (
    select *, price + 100 as original_price, price * 2 - 4000 as final_price,
           concat_ws(',',
               case when product_name is null or trim(product_name) = '' then 'missing_product_name' end,
               case when price < 0 then 'invalid_price_negative' end,
               case when price + 100 < 0 then 'invalid_original_price_negative' end) as validation_errors
    from accounts)
"""

LINES = """
lines as (
    select doc_id, lang, source, unnest(string_split(text, chr(10))) as line,
           unnest(range(len(string_split(text, chr(10))))) as i
    from documents)
"""

STRIPPED = "regexp_replace(line, '^\\s+|\\s+$', '', 'g')"

LINKS = """
links as (
    select page_id, unnest(range(len(names))) as pos, unnest(names) as name, unnest(hrefs) as link
    from (select page_id,
                 regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2) as names,
                 regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1) as hrefs
          from pages))
"""

EVENTS = """
crawled as (
    select event_type as source_name, cast(user_id as varchar) as product_id, event_id, value,
           case when event_type = 'error' then 'at ' else '' end
               || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as crawl_time
    from events)
"""

OFFERS = f"""
offers as (
    select source as source_name, doc_id as product_id, n_chars as price, {key('text')} as k
    from documents),
named as (
    select *, substring(k, 1, 6) as block_key, list_distinct(string_split(k, ' ')) as words
    from offers where k is not null and price > 0)
"""

PAIRS = OFFERS + """,
pairs as (
    select a.block_key, a.source_name as source_a, b.source_name as source_b,
           a.product_id as product_id_a, b.product_id as product_id_b,
           a.price as price_a, b.price as price_b, a.k = b.k as same_name,
           len(list_intersect(a.words, b.words)) as shared,
           len(a.words) + len(b.words) - len(list_intersect(a.words, b.words)) as total
    from named a join named b on a.block_key = b.block_key and a.source_name < b.source_name
     and abs(a.price - b.price) / greatest(a.price, b.price) < 0.3),
scored as (
    select *, shared / total as name_score,
           shared / total * 0.8
           + case when abs(price_a - price_b) / price_a < 0.3 then 0.2 else 0.1 end as similarity_score
    from pairs)
"""

SCORED_COLUMNS = """
block_key, source_a, source_b, product_id_a, product_id_b, price_a, price_b,
round(name_score, 6) as name_score, round(similarity_score, 6) as similarity_score
"""

FLAGGED = PAIRS + """,
flagged as (
    select distinct source_b as source_name, product_id_b as product_id
    from scored where similarity_score >= 0.85 and not same_name),
flagged_exact as (
    select distinct source_b as source_name, product_id_b as product_id
    from scored where similarity_score >= 0.85)
"""

LISTING = f"""
listing as (
    select 'tiki' as source_name, 'BOOK' as standard_category,
           cast(p_size as varchar) as source_category_id, p_type as source_category_name,
           p_brand as source_parent_category_name, cast(null as varchar) as source_category_url,
           cast(p_partkey as varchar) as product_id, p_name as product_name,
           cast(round(p_retailprice) as bigint) as price,
           cast(round(p_retailprice) as bigint) * 1000 as original_price,
           cast(round(p_retailprice) as bigint) as final_price, p_size as discount,
           p_size % 5 + 0.5 as rating_average, cast(p_size as bigint) as review_count,
           cast(null as bigint) as sold_qty, cast(null as integer) as stock_available,
           'https://shop.example/p/' || p_partkey as product_url, cast(null as varchar) as image_url,
           1 as crawl_page, '2024-05-31T10:00:00' as crawl_time, {key('p_name')} as product_key,
           {key('p_name')} as name_key, '{RUN_TS}' as processed_time
    from part),
listing_typed as (select * replace (cast(rating_average as double) as rating_average) from listing)
"""

SIMPLE = f"""
simple as (
    select 'vinabook' as source_name, 'TOYS' as standard_category,
           cast(null as varchar) as source_category_id, p_type as source_category_name,
           cast(null as varchar) as source_parent_category_name,
           'https://shop.example/c/' || p_type as source_category_url,
           cast(p_partkey as varchar) as product_id, p_name as product_name,
           cast(trunc(p_retailprice) as bigint) as price,
           cast(trunc(p_retailprice) as bigint) as original_price,
           cast(trunc(p_retailprice) as bigint) as final_price, cast(null as integer) as discount,
           cast(null as double) as rating_average, cast(null as bigint) as review_count,
           cast(null as bigint) as sold_qty, cast(p_size > 25 as integer) as stock_available,
           cast(null as varchar) as product_url, cast(null as varchar) as image_url,
           cast(null as integer) as crawl_page, '2024-05-31T11:00:00' as crawl_time,
           {key('p_name')} as product_key, {key('p_name')} as name_key,
           '{RUN_TS}' as processed_time
    from part)
"""

ORACLE: dict[str, str] = {
    # --- marts ---
    "category_product_counts": f"""
        with {BASES} select c.category_id, c.category_name,
               count(distinct m.product_id) as total_products
        from categories c join product_category_map m on c.category_id = m.category_id
        group by 1, 2""",
    "category_performance": f"""
        with {BASES},
        shown as (select product_id as known, all_ties.* exclude (product_id)
                  from products left join all_ties using (product_id)),
        facts as (select category_id, category_name, product_id as mapped, shown.*
                  from categories left join product_category_map using (category_id)
                  left join shown on product_id = known)
        select category_id, category_name, count(distinct mapped) as total_products,
               {mean('price')} as avg_price, {mean('final_price')} as avg_final_price,
               {mean('discount_percent')} as avg_discount_percent,
               {mean('sold_qty')} as avg_sold_qty,
               count(distinct known) filter (stock_available) as in_stock_products,
               count(distinct known) filter (not stock_available) as out_stock_products
        from facts group by all""",
    "price_daily": f"""
        with {BASES} select cast(cast(s.processed_time as date) as varchar) as snapshot_date, c.category_id,
               c.category_name, count(distinct s.product_id) as total_products,
               {mean('s.price')} as avg_price, {mean('s.final_price')} as avg_final_price,
               {mean('s.discount_percent')} as avg_discount_percent,
               {mean('s.sold_qty')} as avg_sold_qty
        from product_snapshot s join product_category_map m on s.product_id = m.product_id
        join categories c on m.category_id = c.category_id
        group by 1, 2, 3""",
    "rejected_daily": f"""
        with {BASES} select cast(cast(rejected_at as date) as varchar) as run_date, count(*) as total_rejected
        from rejected_products group by 1""",
    "task_audit_daily": f"""
        with {BASES} select cast(cast(finished_at as date) as varchar) as run_date, count(*) as total_tasks,
               count(*) filter (status = 'success') as success_tasks,
               count(*) filter (status = 'failed') as failed_tasks
        from pipeline_task_audit group by 1""",
    "health_daily": f"""
        with {BASES},
        reported as (
            select cast(processed_at as date) as d, count(distinct process_run_id) as runs,
                   sum(total_products_seen) as seen, sum(products_passed) as passed,
                   sum(products_failed) as failed, sum(duplicate_product_id) as repeated
            from pipeline_runs left join data_quality_reports using (process_run_id) group by 1),
        rejects as (select cast(rejected_at as date) as d, count(*) as n from rejected_products group by 1),
        tasks as (select cast(finished_at as date) as d, count(*) as n,
                         sum(cast(status = 'success' as integer)) as good,
                         sum(cast(status = 'failed' as integer)) as bad
                  from pipeline_task_audit group by 1)
        select cast(d as varchar) as run_date, runs as total_runs,
               cast(coalesce(seen, 0) as bigint) as total_products_seen,
               cast(coalesce(passed, 0) as bigint) as total_products_passed,
               cast(coalesce(failed, 0) as bigint) as total_products_failed,
               cast(coalesce(repeated, 0) as bigint) as total_duplicate_product_id,
               coalesce({percent('failed', 'seen')}, 0) as failure_rate_percent,
               coalesce(rejects.n, 0) as total_rejected, coalesce(tasks.n, 0) as total_tasks,
               cast(coalesce(good, 0) as bigint) as success_tasks,
               cast(coalesce(bad, 0) as bigint) as failed_tasks
        from reported left join rejects using (d) left join tasks using (d)""",
    "quality_runs": f"""
        with {BASES} select r.process_run_id, r.processed_at, r.source_name, r.raw_file_minio,
               r.total_raw_records, q.* exclude (process_run_id)
        from pipeline_runs r join data_quality_reports q on r.process_run_id = q.process_run_id""",
    "failure_rate": f"""
        with {BASES} select r.process_run_id, r.processed_at, q.total_products_seen,
               q.products_failed,
               {percent('q.products_failed', 'q.total_products_seen')} as failure_rate_percent
        from pipeline_runs r join data_quality_reports q on r.process_run_id = q.process_run_id""",
    "latest_one": f"""
        with {BASES} select * replace (cast(price as double) as price,
               cast(final_price as double) as final_price,
               cast(discount_percent as double) as discount_percent)
        from latest_product_snapshot""",
    "latest_all_ties": f"""
        with {BASES} select product_id, processed_time, cast(price as double) as price,
               cast(final_price as double) as final_price,
               cast(discount_percent as double) as discount_percent,
               stock_available, sold_qty, l_orderkey, l_linenumber
        from all_ties""",
    "top_discount": f"""
        with {BASES} select product_id, product_name, cast(price as double) as price,
               cast(final_price as double) as final_price,
               cast(discount_percent as double) as discount_percent, processed_time
        from latest_product_snapshot where discount_percent is not null""",
    "top_sold": f"""
        with {BASES} select product_id, product_name, sold_qty,
               cast(final_price as double) as final_price,
               cast(discount_percent as double) as discount_percent, processed_time
        from latest_product_snapshot where sold_qty is not null""",
    # --- column functions ---
    "parse_long": """
        select p_partkey, cast(round(p_retailprice) as bigint) * 1000 as from_price,
               cast(null as bigint) as from_negative,
               -cast(round(p_retailprice * 100) as bigint) as from_negative_signed,
               cast(null as bigint) as from_currency_word,
               cast(trunc(p_retailprice) as bigint) as from_number,
               cast(p_size > 25 as bigint) as from_flag,
               try_cast(repeat(cast(p_size as varchar), 15) as bigint) as from_long_text
        from part""",
    "parse_double": """
        select p_partkey, cast(cast(p_retailprice as decimal(12,2)) as double) as from_text,
               cast(-p_size as double) as from_open_point,
               cast(null as double) as from_bare_fraction, cast(null as double) as from_exponent,
               cast(null as double) as from_comma
        from part""",
    "digits_price": """
        select p_partkey,
               cast(cast(round(p_retailprice) as bigint) || '000' || p_size as bigint) as from_range,
               cast(p_size as bigint) as from_words, cast(null as bigint) as from_no_digits
        from part""",
    "first_number": """
        select p_partkey, cast(regexp_extract(p_brand, '[0-9]+') as integer) as from_brand,
               cast(regexp_extract(p_brand, '[0-9]+') as integer) as from_two,
               cast(null as integer) as from_none
        from part""",
    "product_key": f"""
        with names as (
            select 'document' as kind, doc_id as id, text as name from documents
            union all
            select 'part', p_partkey,
                   array_to_string(list_transform(string_split(p_name, ' '),
                       lambda w: upper(w[1]) || lower(w[2:])), ' ')
                   || ' (Tái Bản 2023) [HOT] - Bìa Mềm, Tặng Kèm ' || p_brand from part),
        keyed as (select kind, id, {key('name')} as k from names)
        select kind, id, md5(k) as key_md5, length(k) as key_length, substring(k, 1, 6) as block_key,
               len(string_split(k, ' ')) as words
        from keyed""",
    "classify_category": """
        with t as (
            select p_partkey, p_size, lower(coalesce(p_type, '') || ' ' || coalesce(p_name, '')) as a,
                   lower(' ' || coalesce(p_type, '')) as b from part)
        select p_partkey,
               case when a like '%ring%' or a like '%wheel%' then 'RINGS'
                    when a like '%red%' or a like '%blue%' or a like '%green%' then 'COLOURED'
                    when a like '%economy%' or a like '%small%' then 'CHEAP'
                    when a like '%promo%' then 'PROMOTED' else 'OTHER' end as by_type_and_name,
               case when b like '%ring%' or b like '%wheel%' then 'RINGS'
                    when b like '%red%' or b like '%blue%' or b like '%green%' then 'COLOURED'
                    when b like '%economy%' or b like '%small%' then 'CHEAP'
                    when b like '%promo%' then 'PROMOTED' else 'OTHER' end as by_type,
               case when p_size > 25 then 'BOOK' else 'MOM_BABY' end as by_shop_rules
        from t""",
    "absolute_url": """
        with t as (select page_id, url, regexp_replace(url, '^https?://[^/]*', '') as path from pages)
        select page_id, url as from_full, 'https://shop.example' || path as from_rooted,
               'https:/' || path as from_scheme_relative, 'https://shop.example' || path as from_relative,
               'https://shop.example?page=' || page_id as from_query, cast(null as varchar) as from_empty
        from t""",
    # --- sources ---
    "scan_jsonl": "select *, true as has_lineage, false as is_corrupt from part",
    "scan_json_array": "select * from part",
    "scan_json_array_ranges": """
        select doc_id, md5(text) as text_md5, lang, source, n_chars, true as has_lineage, false as is_corrupt
        from documents""",
    "variant_feed_forms": """
        with lines as (
            select p_partkey as p, 'part ' || p_partkey as name,
                   '{"product_id": ' || case when p_partkey % 2 = 0 then p_partkey::varchar else '"' || p_partkey || '"' end
                   || ', "product_name": "part ' || p_partkey || '"'
                   || case p_partkey % 5 when 0 then ', "price": ' || p_partkey
                                         when 1 then ', "price": "' || (p_partkey % 900 + 1) || '.000đ"'
                                         when 2 then ', "price": true'
                                         when 3 then ', "price": {"value": ' || p_partkey || '}' else '' end as line
            from part)
        select case when p % 11 <> 0 then p::varchar end as product_id, case when p % 11 <> 0 then name end as product_name,
               case when p % 11 <> 0 then case p % 5 when 0 then p when 1 then (p % 900 + 1) * 1000 when 2 then 1 end end as price,
               case when p % 11 = 0 then md5(line) end as broken_md5
        from lines""",
    "write_sized_parquet": """
        select l_orderkey, l_linenumber, l_quantity, cast(l_shipdate as varchar) as l_shipdate, l_returnflag from lineitem""",
    "latest_raw_file": "select distinct event_type as source_name, 'run2' as newest_run from events",
    "nested_catalog_explode": f"""
        with {LINES} select 'fahasa' as source_name, 'BOOK' as standard_category,
               lang as source_category_name, '/c/' || lang as source_category_url,
               doc_id || '-' || i as product_id, md5(line) as name_md5,
               cast(length(line) as bigint) * 1000 as price,
               cast(length(line) as bigint) * 1000 as original_price,
               cast(length(line) as bigint) as final_price, cast(i % 100 as integer) as discount,
               cast(null as double) as rating_average, cast(null as bigint) as sold_qty,
               cast(i % 2 as integer) as stock_available, '/d/' || doc_id || '/' || i as product_url,
               cast(null as varchar) as image_url, cast(null as integer) as crawl_page,
               '2024-05-31T12:00:00' as crawl_time, '{RUN_TS}' as processed_time
        from lines""",
    "catalog_envelope": """
        select 'fahasa' as source_name, 'run-1' as run_id, 'catalog' as step,
               lang as source_category_name, '/api/' || doc_id as response_url, 200 as status,
               'application/json' as content_type, true as is_success,
               cast(len(string_split(text, chr(10))) as integer) as products,
               md5(string_split(text, chr(10))[-1]) as last_name_md5
        from documents""",
    "nested_empty": """
        select 'tiki' as source_name, cast(p_partkey as varchar) as product_id, p_name as product_name
        from part""",
    "listing_api_explode": f"""
        with {LINES} select 'BOOK' as standard_category, cast(doc_id as varchar) as source_category_id,
               lang as source_category_name, cast(doc_id * 100000 + i as varchar) as product_id, md5(line) as name_md5,
               cast(length(line) as bigint) as price, cast(length(line) + 1 as bigint) as original_price,
               i % 50 as discount, cast(i % 5 + 0.5 as double) as rating_average, i as review_count,
               case when i % 3 = 0 then cast(length(line) as bigint) end as sold_qty,
               case when i % 4 <> 0 then 'https://shop.example/d/' || doc_id || '/' || i end as product_url,
               1 as crawl_page, cast(doc_id * 100000 + i as varchar) as raw_id
        from lines""",
    "category_tree_flatten": """
        with recursive nodes as (
            select 'r' || r_regionkey as id, r_name as name, lower(r_name) as k,
                   cast(null as varchar) as up from region
            union all
            select 'n' || n_nationkey, n_name,
                   case when n_nationkey % 6 <> 0 then lower(n_name) end, 'r' || n_regionkey from nation
            union all
            select distinct 's-' || c_nationkey || '-' || c_mktsegment, c_mktsegment,
                   lower(c_mktsegment), 'n' || c_nationkey from customer),
        tree as (
            select id, name, k, cast(null as varchar) as parent, 0 as depth from nodes where up is null
            union all
            select n.id, n.name, n.k, t.name, t.depth + 1 from nodes n join tree t on n.up = t.id)
        select id as category_id, name as category_name, k as url_key, parent as parent_name, depth
        from tree where k <> ''""",
    "nested_category_payloads": f"""
        with {LINES}
        select distinct cast(doc_id as varchar) as category_id, source as category_name, lang as url_key,
               cast(null as varchar) as parent_name, 0 as depth from documents
        union all
        select doc_id || '-' || i, md5(line), 'l' || i, source, 1 from lines where i % 4 > 0
        union all
        select doc_id || '-' || i || '-n', cast(length(line) as varchar), 'size', md5(line), 2 from lines""",
    "category_chain": """
        with recursive tree as (
            select c_custkey as id, c_mktsegment as name, cast(null as varchar) as parent, 0 as depth
            from customer where c_custkey = 0
            union all
            select c_custkey, c_mktsegment, t.name, t.depth + 1
            from customer join tree t on c_custkey = t.id + 1)
        select cast(id as varchar) as category_id, name as category_name, 'k' as url_key, parent as parent_name, depth
        from tree""",
    "html_cards": f"""
        with {LINKS} select page_id, cast(pos as integer) as pos, name as name_text, link from links""",
    "html_field_fallbacks": f"""
        with {LINKS} select page_id, cast(pos as integer) as pos,
               case when pos % 10 = 1 then 'alt ' || name else name end as product_name,
               'https://shop.example' || link as product_url,
               case when pos % 10 < 7 then 'https://img.example' || link
                    else 'https://shop.example' || link end as image_url,
               case when pos % 10 < 5 then cast(page_id as varchar)
                    else string_split(rtrim('https://shop.example' || link, '/'), '/')[-1] end as product_id,
               pos * 1000 as price, cast(null as bigint) as original_price,
               cast(pos as integer) as discount,
               case when pos % 10 = 0 then false end as stock_available
        from links""",
    "html_phuongnam": f"""
        with {LINES} select 'phuongnam' as source_name, lang as source_category_name,
               cast(doc_id as integer) as crawl_page, cast(null as varchar) as product_id,
               md5({STRIPPED}) as name_md5, length(line) * 1000 as price,
               (length(line) + 1) * 1000 as original_price, cast(null as integer) as discount,
               cast(null as boolean) as stock_available,
               'https://nhasachphuongnam.com/p/' || (i // 2) as product_url,
               'https://cdn.example/' || doc_id || '/' || i || '.jpg' as image_url
        from lines where line <> ''
        qualify row_number() over (partition by doc_id, i // 2 order by i) = 1""",
    "html_vinabook": f"""
        with {LINES} select 'vinabook' as source_name, lang as source_category_name,
               cast(doc_id as integer) as crawl_page,
               case when i % 3 = 0 then cast(i as varchar) else doc_id || '-' || i end as product_id,
               md5({STRIPPED}) as name_md5, length(line) as price,
               cast(null as bigint) as original_price, cast(i % 100 as integer) as discount,
               case when i % 4 = 0 then false end as stock_available,
               'https://www.vinabook.com/products/' || doc_id || '-' || i || '/' as product_url,
               'https://www.vinabook.com/i/' || i || '.jpg' as image_url
        from lines where line <> ''""",
    "html_bookbuy": f"""
        with {LINES} select 'bookbuy' as source_name, lang as source_category_name,
               cast(doc_id as integer) as crawl_page, cast(i as varchar) as product_id,
               md5({STRIPPED}) as name_md5, length(line) as price, length(line) + 1 as original_price,
               cast(i % 100 as integer) as discount, cast(null as boolean) as stock_available,
               'https://bookbuy.vn/b/' || doc_id || '/' || i as product_url,
               'https://bookbuy.vn/v/' || i || '.jpg' as image_url
        from lines where line <> ''""",
    # --- projection and normalization ---
    "project_tolerant": """
        select cast(p_partkey as varchar) as p_partkey, p_name, cast(null as bigint) as p_weight
        from part""",
    "project_nested_tolerant": """
        select o_orderkey, o_totalprice as total, cast(null as double) as absent,
               cast(null as varchar) as too_deep, 'double' as total_type
        from orders""",
    "normalize_listing": f"with {LISTING} select * from listing_typed",
    "normalize_simple": f"with {SIMPLE} select * from simple",
    "normalize_union": f"""
        with {LISTING}, {SIMPLE} select * from listing_typed
        union all by name
        select * replace ('bookbuy' as source_name, cast(null as bigint) as original_price,
                          cast(null as integer) as stock_available) from simple""",
    "category_allowlist": """
        select p_partkey, p_brand, p_type from part
        where p_brand in (select p_brand from part where p_size = 50)""",
    "enrich_detail": """
        with d as (
            select l_orderkey, count(*) as n, max(l_linenumber) > 1 as answered,
                   cast(sum(l_quantity) as bigint) as q,
                   strftime(max(l_shipdate), '%Y-%m-%d') as seen
            from lineitem group by 1),
        j as (
            select o_orderkey, case when o_orderstatus <> 'P' then '/o/' || o_orderkey end as url,
                   case when o_orderstatus <> 'P' then d.n end as n, d.answered, d.q,
                   case when o_orderstatus <> 'P' then d.seen end as seen
            from orders left join d on o_orderkey = l_orderkey),
        s as (
            select *, case when url is null then 'missing_product_url'
                           when n is null then 'not_attempted'
                           when n = 3 then 'error'
                           when not answered then 'no_flashsale_response'
                           when n = 5 then 'no_flashsale_data'
                           else 'success' end as status
            from j)
        select o_orderkey, url as product_url,
               case when status = 'success' then cast(q - 100 > 0 as integer) end as stock_available,
               case when status = 'success' then q else -1 end as sold_qty,
               status as detail_status,
               case status when 'missing_product_url' then 'product_url is missing'
                    when 'no_flashsale_response' then 'Flashsale API response timeout or not triggered'
                    when 'error' then 'HTTP 500' end as detail_error,
               seen as detail_crawl_time
        from s""",
    # --- deduplication, validation, counts ---
    "dedup_key": f"""
        select p_partkey,
               case p_partkey % 7 when 0 then cast(p_partkey as varchar) when 1 then '/p/' || p_partkey
                    when 2 then '/p/' || p_partkey when 4 then '漢字' when 5 then null
                    else {key('p_name')} end as dedup_key
        from part""",
    "latest_per_source_key": f"""
        with {EVENTS}, given as (
            select * replace (case when event_id % 10 = 0 then null when event_id % 3 = 0 then 'hot'
                                   else product_id end as product_id) from crawled)
        select source_name, product_id, event_id, value, crawl_time
        from (select *, row_number() over (partition by source_name, product_id
                     order by crawl_time desc, event_id) as rn from given)
        where rn = 1 or product_id is null""",
    "first_wins_dedup": """
        select doc_id, source, n_chars
        from (select *, row_number() over (partition by text order by doc_id) as rn from documents)
        where rn = 1""",
    "validate_rows": f"""
        with {ACCOUNTS} select source_name, product_id, price, validation_errors from checked""",
    "valid_rows": f"""
        with {ACCOUNTS} select source_name, product_id, product_name, price from checked
        where validation_errors = ''""",
    "rejected_rows": f"""
        with {ACCOUNTS} select source_name, product_id, price, validation_errors from checked
        where validation_errors <> ''""",
    "reject_report": f"""
        with {ACCOUNTS} select source_name, product_id, product_name, price, validation_errors
        from checked where validation_errors <> ''""",
    "data_quality_report": f"""
        with {ACCOUNTS},
        r as (select * replace (case when cast(product_id as bigint) % 11 <> 0
                                     then cast(product_id as bigint) % 40 end as product_id) from checked)
        select process_run_id, count(*) as total_products_seen,
               count(*) filter (validation_errors = '') as products_passed,
               count(*) filter (validation_errors <> '') as products_failed,
               count(*) filter (product_id is null) as missing_product_id,
               count(*) filter (trim(product_name) = '') as missing_product_name,
               count(*) filter (product_url is null) as missing_product_url,
               count(*) filter (price < 0) as invalid_price_negative,
               count(*) filter (final_price < 0) as invalid_final_price_negative,
               count(*) filter (final_price > price) as final_price_greater_than_price,
               count(product_id) - count(distinct product_id) as duplicate_product_id
        from r group by 1""",
    "stage_counts": """
        select event_type as source_name, count(*) as before_validate,
               count(*) filter (value >= 20) as after_validate,
               count(*) filter (value >= 20 and event_type <> 'error') as after_dedup
        from events group by 1""",
    "run_summary": f"""
        select '{RUN_TS}' as processed_at, 'pyspark' as engine,
               coalesce(event_type, 'all sources') as source_name,
               case event_type when 'click' then 'raw/click/1.jsonl' when 'view' then 'raw/view/7.jsonl' end
                   as source_file,
               count(*) as total_before_validate,
               count(*) filter (value >= 20) as total_valid_before_dedup,
               count(*) filter (value >= 20 and event_type <> 'error') as total_after_dedup,
               count(*) filter (value < 20) as bad_products,
               count(*) filter (value < 5) as malformed_records,
               count(*) filter (value >= 20 and event_type = 'error') as duplicate_products
        from events group by rollup (event_type)""",
    "feed_totals": """
        select event_type, cast(cast(ts as date) as varchar) as run_id, count(*) as total_products
        from events group by 1, 2""",
    "crawl_summary": f"""
        with {LINES} select source as source_name,
               count(distinct lang) as total_subcategories_collected,
               count(distinct doc_id) as total_catalog_responses, count(*) as total_products,
               count(*) filter (i % 5 = 0) as detail_success,
               count(*) filter (i % 5 = 3) as detail_missing,
               count(*) filter (i % 5 = 1) as no_flashsale_data,
               count(*) filter (i % 5 = 4) as no_flashsale_response,
               count(*) filter (i % 5 = 2) as detail_error
        from lines group by 1""",
    "completeness_check": """
        select cast((select sum(p_size) from part) as bigint) as expected_total,
               count(*) as actual_total,
               count(*) >= (select sum(p_size) from part) as is_complete
        from lineitem""",
    # --- the published table ---
    "table_sample": "select event_id, event_type, value from events order by event_id limit 5",
    "freshness_check": f"""
        with {EVENTS} select count(*) as total_rows,
               strftime(max(try_cast(crawl_time as timestamp)), '%Y-%m-%d %H:%M:%S.%f') as last_crawl_time
        from crawled""",
    "source_coverage": """
        with known(s, e) as (values ('click', 'required'), ('view', 'required'), ('purchase', 'required'),
                                    ('refund', 'required'), ('error', 'optional'), ('share', 'optional')),
        found as (select distinct event_type as s from events where event_type <> '')
        select coalesce(f.s, k.s) as source_name,
               case when k.e is null then 'unexpected' when f.s is not null then 'present'
                    else 'missing_' || k.e end as status
        from found f full join known k on f.s = k.s""",
    "dataset_gate": f"""
        with {EVENTS},
        f as (select count(*) as n, count(distinct source_name) as sources,
                     count(distinct source_name) filter (source_name not in
                         ('click', 'view', 'purchase', 'refund', 'error', 'share')) as unexpected,
                     max(try_cast(crawl_time as timestamp)) as newest from crawled),
        m as (select (select string_agg(s, ',' order by s) from (values ('click'), ('view'), ('purchase'),
                          ('refund')) r(s) where s not in (select source_name from crawled)) as required,
                     (select string_agg(s, ',' order by s) from (values ('error'), ('share')) o(s)
                      where s not in (select source_name from crawled)) as optional)
        select 'has_rows' as check_name, n > 0 as passed, cast(n as varchar) as detail from f
        union all select 'required_sources', required is null, coalesce(required, '') from m
        union all select 'optional_sources', true, coalesce(optional, '') from m
        union all select 'unexpected_sources', unexpected = 0, cast(unexpected as varchar) from f
        union all select 'source_count', sources in (4, 5), cast(sources as varchar) from f
        union all select 'crawl_time', newest is not null,
                         coalesce(strftime(newest, '%Y-%m-%d %H:%M:%S'), 'none') from f""",
    "write_single_parquet": "select doc_id, source, lang, n_chars, md5(text) as text_md5 from documents",
    "write_partitioned_parquet": "select doc_id, source, lang, n_chars, md5(text) as text_md5 from documents",
    "publish_external_table": "select event_id, event_type, user_id, value from events",
    "publish_table": "select event_id, event_type, user_id, value from events",
    "describe_table": """
        select cast(row_number() over () - 1 as integer) as position, column_name,
               case column_type when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz'
                    else lower(column_type) end as data_type
        from (describe events)""",
    # --- entity resolution ---
    "er_candidate_pairs": f"""
        with {OFFERS},
        sets as (
            select block_key, list_sort(words) as ws, md5(array_to_string(list_sort(words), ' ')) as set_id,
                   len(words) as n, min(source_name) as s1, max(source_name) as s2,
                   min(price) as p1, max(price) as p2
            from named group by 1, 2, 3, 4),
        tokens as (select block_key, set_id, n, s1, s2, p1, p2, unnest(ws) as word from sets),
        counted as (select *, count(*) over (partition by block_key, word) as n_sets from tokens),
        ranked as (select *, row_number() over (partition by block_key, set_id order by n_sets, word) - 1 as r
                   from counted),
        rare as (select * from ranked where r < n - ceil(n * 13 / 16) + 1)
        select distinct a.block_key, a.set_id as set_a, b.set_id as set_b
        from rare a join rare b on a.block_key = b.block_key and a.word = b.word and a.set_id < b.set_id
        where 29 * least(a.n - a.r, b.n - b.r) >= 13 * (a.n + b.n)
          and a.p1 * 0.69 < b.p2 and b.p1 * 0.69 < a.p2
          and not (a.s1 = a.s2 and b.s1 = b.s2 and a.s1 = b.s1)""",
    "er_scored_pairs": f"""
        with {PAIRS} select {SCORED_COLUMNS} from scored where name_score >= 0.8125 and not same_name""",
    "er_matched_pairs": f"""
        with {PAIRS} select {SCORED_COLUMNS} from scored where similarity_score >= 0.85 and not same_name""",
    "er_duplicates": f"""
        with {FLAGGED} select source_name, product_id, price from offers
        where (source_name, product_id) in (select (source_name, product_id) from flagged)""",
    "er_survivors": f"""
        with {FLAGGED} select source_name, product_id, price from offers
        where (source_name, product_id) not in (select (source_name, product_id) from flagged)""",
    "er_exact_survivors": f"""
        with {FLAGGED} select source_name, product_id, price from offers
        where (source_name, product_id) not in (select (source_name, product_id) from flagged_exact)""",
    "duplicate_report": f"""
        with {FLAGGED} select source_name, product_id, source_name as product_name, price,
               '{RUN_TS}' as processed_time
        from offers where (source_name, product_id) in (select (source_name, product_id) from flagged)""",
    # --- the whole run ---
    "raw_feed_forms": """
        select cast(p_partkey as varchar) as item,
               case p_partkey % 7 when 2 then p_partkey * 1000 + 500 when 3 then (p_partkey % 900 + 1) * 1000
                    else p_partkey end as price,
               case p_partkey % 3 when 0 then 7 when 1 then 1 else 0 end::bigint as stock
        from part where p_partkey % 7 < 5
        union all select 'invalid_price_negative', count(*), null from part where p_partkey % 7 = 5 having count(*) > 0
        union all select 'malformed_record', count(*), null from part where p_partkey % 7 = 6 having count(*) > 0
        union all select 'missing_product_name', count(*), null from part where p_partkey % 7 = 6 having count(*) > 0""",
    "latest_raw_folder": """
        select 'vinabook' as source_name, cast(p_partkey as varchar) as product_id, p_partkey + 1 as price,
               'b.jsonl' as feed from part
        union all
        select 'bookbuy', cast(p_partkey as varchar), p_partkey + 1000000001, 'b.jsonl' from part""",
    "process_end_to_end": f"""
        with raw as (
            select (['tiki', 'phuongnam', 'fahasa', 'vinabook', 'bookbuy'])[
                       cast(regexp_extract(source, '[0-9]+') as integer) % 5 + 1] as source_name,
                   doc_id, text, n_chars from documents),
        canonical as (
            select source_name, case when source_name <> 'phuongnam' then cast(doc_id as varchar) end as product_id,
                   text as product_name, n_chars as price,
                   case when source_name <> 'fahasa' then n_chars end as final_price,
                   case when source_name = 'fahasa' then '/d/' || doc_id
                        else '/d/' || (doc_id // 2) end as product_url,
                   '2024-05-01 ' || lpad(cast(n_chars as varchar), 8, '0') as crawl_time
            from raw),
        latest as (
            select * from (
                select *, coalesce(product_id, product_url) as id, row_number() over (
                    partition by source_name, coalesce(product_id, product_url)
                    order by crawl_time desc, product_name) as rn
                from canonical)
            where rn = 1 and trim(product_name) <> ''),
        keyed as (select *, {key('product_name')} as k from latest),
        named as (select source_name, id, price, k, substring(k, 1, 6) as block_key,
                         list_distinct(string_split(k, ' ')) as words
                  from keyed where k is not null and price > 0),
        pairs as (
            select b.source_name, b.id, a.price as pa, b.price as pb,
                   len(list_intersect(a.words, b.words)) as shared, len(a.words) + len(b.words) as word_total
            from named a join named b on a.block_key = b.block_key and a.source_name < b.source_name
             and a.k <> b.k and abs(a.price - b.price) / greatest(a.price, b.price) < 0.3),
        flagged as (
            select distinct source_name, id from pairs
            where shared / (word_total - shared) * 0.8
                  + case when abs(pa - pb) / pa < 0.3 then 0.2 else 0.1 end >= 0.85)
        select source_name, product_id, price, final_price, product_url,
               md5(product_name) as name_md5, crawl_time, '{RUN_TS}' as processed_time
        from latest
        where not exists (select 1 from flagged f where f.source_name = latest.source_name and f.id = latest.id)""",
}

# What is added feed by feed equals what is read at once.
ORACLE |= {
    "latest_state_two_feeds": ORACLE["latest_per_source_key"],
    "process_two_updates": ORACLE["process_end_to_end"],
    "merged_category_counts": ORACLE["category_product_counts"],
    "merged_category_stock": f"""
        select category_id, category_name, total_products, in_stock_products, out_stock_products
        from ({ORACLE["category_performance"]})""",
    "merged_price_daily": ORACLE["price_daily"],
}

# A view's rows are those of its mart.
ORACLE |= {
    view: ORACLE[mart]
    for view, mart in {
        "vw_category_product_counts": "category_product_counts",
        "vw_dm_category_performance": "category_performance",
        "vw_dm_pipeline_health_daily": "health_daily",
        "vw_pipeline_quality_runs": "quality_runs",
        "vw_pipeline_failure_rate": "failure_rate",
        "vw_dm_price_daily": "price_daily",
        "vw_latest_product_snapshot": "latest_one",
        "vw_top_discount_products": "top_discount",
        "vw_top_sold_products": "top_sold",
    }.items()
}
