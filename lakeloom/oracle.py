"""SQL of the core queries, in DuckDB's dialect, over the same tables."""

from __future__ import annotations

WS = r"[\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PYTHON_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
URL = r"^(?i)(https?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
AUTHORITY = r"^(\[[0-9A-Fa-f:.]+\]|[^:@\[\]\s]+)(?::(\d*))?$"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def part(url: str, g: int) -> str:
    return f"regexp_extract({strip(url)}, '{URL}', {g})"


def host(url: str) -> str:
    return f"nullif(lower(regexp_extract({part(url, 2)}, '{AUTHORITY}', 1)), '')"


def normalized(url: str) -> str:
    scheme, port = f"lower({part(url, 1)})", f"regexp_extract({part(url, 2)}, '{AUTHORITY}', 2)"
    shown = f"case when {port} = '' or {port} = case when {scheme} = 'http' then '80' else '443' end then '' else ':' || {port} end"
    path = f"case when {part(url, 3)} = '' then '/' else {part(url, 3)} end"
    return f"case when {scheme} <> '' and {host(url)} is not null then {scheme} || '://' || {host(url)} || {shown} || {path} || {part(url, 4)} end"


def stable_int(value: str, seed: str | int) -> str:
    return f"cast(('0x' || substr(sha256('{seed}:' || cast({value} as varchar)), 1, 16))::ubigint & 9223372036854775807::ubigint as bigint)"


def dedup_form(x: str) -> str:
    return strip(rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{M}}\p{{N}}_]+', ' ', 'g')")


def clean(x: str) -> str:
    x = rf"regexp_replace(nfc_normalize({x}), '\r\n?', chr(10), 'g')"
    x = rf"regexp_replace({x}, '[ \t\f\x0b]+', ' ', 'g')"
    x = f"regexp_replace({x}, '(?m)^ +| +$', '', 'g')"
    x = rf"regexp_replace({x}, ' +([,.;:!?%])', '\1', 'g')"
    return strip(rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')")


HAN = r"[\x{3400}-\x{9fff}]"


def tokens(x: str) -> str:
    words = rf"regexp_extract_all(regexp_replace(lower({x}), '{HAN}+', ' ', 'g'), '[\p{{L}}\p{{M}}\p{{N}}_]+(?:[-.][\p{{L}}\p{{M}}\p{{N}}_]+)*')"
    grams = f"flatten(list_transform(regexp_extract_all(lower({x}), '{HAN}+'), lambda r: list_transform(range(1, greatest(length(r), 2)), lambda i: substr(r, i, 2))))"
    return f"list_concat({words}, {grams})"


def token_count(x: str) -> str:
    rest = strip(f"regexp_replace({x}, '{HAN}', ' ', 'g')")
    words = f"case when {rest} = '' then 0 else len(regexp_split_to_array({rest}, '{WS}+')) end"
    return rf"cast(greatest(1, length(regexp_replace({x}, '[^\x{{3400}}-\x{{9fff}}]', '', 'g')) + floor(({words}) * 1.25)) as integer)"


RANK = "case crawl_status when 'FAILED' then 1 when 'ROBOTS_DENIED' then 2 when 'UNSUPPORTED' then 3 when 'TOO_LARGE' then 4 when 'EMPTY_CONTENT' then 5 when 'NEEDS_JS' then 6 when 'NEEDS_OCR' then 7 when 'SUCCESS' then 8 else 0 end"
PROFILED = "('SUCCESS','FAILED','EMPTY_CONTENT','NEEDS_JS','ROBOTS_DENIED','TOO_LARGE','UNSUPPORTED','NEEDS_OCR')"
CATEGORY = "case when status in ('SUCCESS','FAILED','EMPTY_CONTENT','NEEDS_JS','ROBOTS_DENIED') then status else 'OTHER' end"

TIMED = """
    attempts_once as (select fetch_key, attempt, domain, status, elapsed_seconds from timing_log
        qualify row_number() over (partition by fetch_key, attempt order by logged_at desc nulls last, finished_at desc nulls last, elapsed_seconds desc nulls last) = 1),
    targets as (select fetch_key, min(domain) as domain, count(*) as attempts, sum(elapsed_seconds) as seconds, arg_max(status, attempt) as status from attempts_once group by fetch_key)
"""
COST = "0.7 * median(seconds) + 0.3 * quantile_disc(seconds, 0.95)"


def bm25(name: str, fields: dict[str, float], k: int = 1000) -> str:
    """CTEs of a search of documents by the titles of every fiftieth document."""
    out = [f"{name}_q as (select doc_id as query_id, unnest({tokens('title')}) as token from documents where doc_id % 50 = 0 and title is not null)", f"{name}_u as (select query_id, token, count(*) as uses from {name}_q group by all)"]
    scores = []
    for f, boost in fields.items():
        t = f"{name}_{f}"
        out.append(f"{t}_d as (select doc_id, {tokens(f'coalesce({f}, chr(32))')} as toks from documents)")
        out.append(f"{t}_s as (select count(*) as n, avg(len(toks)) as avgdl from {t}_d)")
        out.append(f"{t}_p as (select doc_id, len(toks) as dl, unnest(toks) as token from {t}_d)")
        out.append(f"{t}_f as (select doc_id, token, any_value(dl) as dl, count(*) as tf from {t}_p group by doc_id, token)")
        out.append(f"{t}_i as (select token, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) as idf from {t}_f, {t}_s group by token)")
        scores.append(f"select query_id, doc_id, uses * ({boost} * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) as s from {name}_u join {t}_f using (token) join {t}_i using (token), {t}_s")
    out.append(f"{name}_all as (select query_id, doc_id, round(sum(s), 6) as score from ({' union all '.join(scores)}) group by all)")
    out.append(f"{name} as (select query_id, doc_id, score, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from {name}_all where score > 0 qualify rank <= {k})")
    return ", ".join(out)


#: The log with attempts logged a second time with another status.
PLANTED = "select fetch_key, attempt, status from timing_log union all select fetch_key, attempt, 'PLANTED' from timing_log where attempt = 1 and fetch_key like '%0'"

DENSE = """
    pairs as (select q.vec_id as query_id, v.vec_id, round(list_inner_product(cast(q.embedding as double[]), cast(v.embedding as double[])), 6) as score
        from embeddings q, embeddings v where q.vec_id % 50 = 0 and v.embedding is not null),
    dense as (select query_id, vec_id, score, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs qualify rank <= 500)
"""

RISK = rf"""
    rows as (select distinct on (doc_id) doc_id, domain, coalesce(title, '') as title, coalesce(text, '') as text, text_chars as stored_chars, bytes_downloaded, content_hash, language from corpus where crawl_status = 'SUCCESS'),
    same as (select content_hash, count(*) as n_same from rows where content_hash is not null group by all),
    facts as (select r.*, n_same, case when coalesce(stored_chars, 0) > 0 then stored_chars else length(text) end as chars,
        {dedup_form("substr(text, 1, 4000)")} as lead_, {dedup_form("title")} as head,
        list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip("x")}), lambda x: x <> '') as lines,
        list_filter(list_transform(regexp_split_to_array(text, '\n[\t\n\x0b\f\r ]*\n'), lambda x: {strip("x")}), lambda x: x <> '') as blocks from rows r left join same using (content_hash)),
    more as (select *, chars / greatest(1, coalesce(bytes_downloaded, 0)) as ratio, list_transform(list_filter(blocks, lambda x: length(x) >= 30), lambda x: {dedup_form("x")}) as formed,
        len(list_filter(['all rights reserved', 'cookie', 'đăng nhập', 'chia sẻ', 'bình luận', 'quảng cáo', '版权所有', '登录'], lambda m: contains(lower(text), m))) as hits from facts),
    flagged as (select doc_id, domain, chars, hits, list_filter([
        case when chars < 300 then 'very_short_text' end, case when chars >= 300 and chars < 600 then 'short_text' end, case when chars >= 600 and chars < 1000 then 'brief_text' end,
        case when ratio < 0.003 then 'very_low_text_ratio' end, case when ratio >= 0.003 and ratio < 0.01 then 'low_text_ratio' end, case when ratio >= 0.01 and ratio < 0.02 then 'moderate_text_ratio' end,
        case when n_same > 1 then 'duplicate_content' end, case when head = '' then 'missing_title' end,
        case when head <> '' and not contains(lead_, head) and len(list_intersect(list_distinct(string_split(head, ' ')), string_split(lead_, ' '))) / len(list_distinct(string_split(head, ' '))) < 0.35 then 'title_body_mismatch' end,
        case when len(lines) >= 6 and len(list_filter(lines, lambda x: regexp_matches(x, '^[#*|-]'))) / len(lines) > 0.6 then 'list_heading_dominant' end,
        case when len(blocks) > 0 and list_max(list_transform(blocks, lambda x: length(x))) < 120 then 'no_substantial_paragraph' end,
        case when len(formed) > 0 and (len(formed) - len(list_distinct(formed))) / len(formed) >= 0.2 then 'repeated_blocks' end,
        case when coalesce(language, '') = '' then 'missing_language' end, case when chars > 50000 then 'extreme_length' end, case when hits > 0 then 'boilerplate_markers' end
        ], lambda x: x is not null) as reasons from more),
    scored as (select doc_id, domain, cast(chars as integer) as text_chars, reasons, cast(least(100, list_sum(list_concat([0], list_transform(reasons, lambda r: case r
        when 'very_short_text' then 30 when 'short_text' then 20 when 'brief_text' then 10 when 'very_low_text_ratio' then 20 when 'low_text_ratio' then 10 when 'moderate_text_ratio' then 5
        when 'duplicate_content' then 20 when 'missing_title' then 15 when 'title_body_mismatch' then 10 when 'list_heading_dominant' then 10 when 'no_substantial_paragraph' then 15
        when 'repeated_blocks' then 10 when 'missing_language' then 5 when 'extreme_length' then 5 else least(20, 5 * hits) end)))) as integer) as risk from flagged)
"""
NOW = 1930100000.0
READY = f"""
    ready as (select fetch_key, min(domain) as domain, min(doc_id) as first_doc, max(attempts) as attempts,
        arg_max(status, row(attempts, status)) as status, min(next_retry_at) as next_retry_at from crawl_tasks
        where status = 'PENDING' or (status = 'RETRY_WAIT' and next_retry_at <= {NOW}) group by fetch_key),
    turns as (select *, case when status = 'RETRY_WAIT' then 0 else 1 end as late, row_number() over (partition by domain order by case when status = 'RETRY_WAIT' then 0 else 1 end, coalesce(next_retry_at, 0), first_doc, fetch_key) as turn from ready where domain is not null),
    claimed as (select fetch_key, domain, cast(row_number() over (order by late, turn, domain, fetch_key) as integer) as claim_no from turns where turn <= 100 order by late, turn, domain, fetch_key limit 100)
"""


# The generic rule only: no host of the test tables has a rule of its own.
CURATED = rf"""
    r as (select distinct on (doc_id) doc_id, domain, coalesce(text, '') as raw from corpus where crawl_status = 'SUCCESS'),
    u as (select *, string_split(regexp_replace(regexp_replace(regexp_replace(replace(nfc_normalize(raw), chr(160), ' '), '[\x{{200b}}\x{{200c}}\x{{200d}}\x{{feff}}\x{{2060}}\x{{ad}}]', '', 'g'), '\r\n?', chr(10), 'g'), '(?m)[ \t]+$', '', 'g'), chr(10)) as ls from r),
    c as (select *, coalesce(list_position(list_transform(ls, lambda x: regexp_matches({strip("x")}, '(?i)^(?:#+\s*(?:chia sẻ|share|bình luận|comment|bài viết liên quan|tin liên quan|tin cùng chuyên mục|theo dõi chúng tôi|kết nối với chúng tôi|thông tin liên hệ)|©\s*(?:copyright|bản quyền))')), true), 0) as cut from u),
    k as (select *, array_to_string(list_filter(case when cut > 0 then ls[1:cut - 1] else ls end, lambda x: lower({strip("x")}) not in ('chia sẻ', 'share', 'like', 'tweet', 'in bài')), chr(10)) as kept from c),
    f as (select *, {strip(r"regexp_replace(regexp_replace(kept, '(?:(?:^|\n)\s*(?:---|___|\*\*\*)\s*)+$', ''), '\n{3,}', chr(10) || chr(10), 'g')")} as t from k),
    curated as (select doc_id, domain, cast(length(raw) as integer) as raw_text_chars, cast(length(t) as integer) as text_chars, cast(greatest(0, length(raw) - length(t)) as integer) as removed_chars, sha256(t) as content_hash, case when length(t) >= 50 then 'CLEAN' else 'LOW_QUALITY' end as curation_status from f)
"""


def sql() -> dict[str, str]:
    u = normalized("url")
    best = f"row_number() over (partition by doc_id order by {RANK} desc, (content_hash is not null) desc, coalesce(text_chars, 0) desc, coalesce(http_status, 0) desc, coalesce(content_hash, '') desc, coalesce(text, '') desc, crawl_status desc, coalesce(bytes_downloaded, 0) desc)"
    matrix = ", ".join(f"count(*) filter (status = '{s}') as n_{s.lower()}" for s in PROFILED.strip("()").replace("'", "").split(","))
    two = f"{bm25('lexical', {'title': 2.0, 'text': 1.0})}, {DENSE}, chunks as (select query_id, vec_id // 4 as doc_id, max(score) as score from dense group by all), vectors as (select query_id, doc_id, score, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from chunks qualify rank <= 1000)"
    fused = """, fused as (select coalesce(l.query_id, d.query_id) as query_id, coalesce(l.doc_id, d.doc_id) as doc_id, l.rank as lexical_rank, d.rank as dense_rank,
        round(coalesce(1.0 / (60 + l.rank), 0) + coalesce(1.0 / (60 + d.rank), 0), 9) as fused_score from lexical l full join vectors d on l.query_id = d.query_id and l.doc_id = d.doc_id),
        first as (select *, cast(row_number() over (partition by query_id order by fused_score desc, coalesce(lexical_rank, 999999), doc_id) as integer) as final_rank from fused qualify final_rank <= 1000)"""
    return {
        "url_keys": f"select distinct doc_id, {u} as normalized_url, {host('url')} as host, sha256({u}) as fetch_key, lower({part('url', 3)}) like '%.pdf' as is_pdf from corpus",
        "source_report": f"with u as (select {u} as u, count(*) as n, sum(case when lower({part('url', 3)}) like '%.pdf' then 1 else 0 end) as pdf from crawl_tasks group by 1) select cast(sum(n) as bigint) as n_rows, count(u) as n_urls, cast(sum(case when u is not null then n - 1 else 0 end) as bigint) as n_repeats, cast(sum(case when u is null then n else 0 end) as bigint) as n_invalid, cast(sum(case when u is not null then pdf else 0 end) as bigint) as n_pdf from u",
        "query_params": rf"with p as (select split_part(unnest(string_split(regexp_extract({u}, '\?(.*)$', 1), '&')), '=', 1) as param from crawl_tasks where {u} is not null) select param, count(*) as n from p where param <> '' group by param",
        "top_domains": "select domain, count(*) as n from corpus group by domain order by n desc, domain limit 20",
        "status_counts": "select coalesce(status, 'TOTAL') as status, count(*) as n from crawl_tasks group by rollup(status)",
        "domain_status_matrix": f"select domain, count(*) as n_tasks, {matrix} from crawl_tasks group by domain",
        "content_duplicates": "select content_hash, count(distinct doc_id) as n_docs, min(doc_id) as first_doc from corpus where content_hash is not null group by content_hash having count(distinct doc_id) > 1",
        "fetch_fanout": "with r as (select distinct fetch_key, doc_id from crawl_tasks where fetch_key is not null), n as (select fetch_key, count(*) as n_docs from r group by fetch_key having count(*) > 1) select fetch_key, doc_id, n_docs from r join n using (fetch_key)",
        "target_timings": f"with {TIMED} select fetch_key, domain, attempts, round(seconds, 6) as seconds, status from targets",
        "timing_conflicts": f"with l as ({PLANTED}) select fetch_key, attempt from l group by all having min(status) <> max(status)",
        "latency_profile": f"with {TIMED} select domain, count(*) as n, round(median(seconds), 9) as median_seconds, round(quantile_disc(seconds, 0.95), 9) as p95_seconds, round({COST}, 9) as cost from targets where seconds is not null group by domain",
        "domain_work": f"""with {TIMED},
            rates as (select domain, {CATEGORY} as category, count(*) as k from crawl_tasks where status in {PROFILED} group by all),
            whole as (select domain, sum(k) as sample_count from rates group by all), total as (select domain, count(*) as n_urls from crawl_tasks group by all),
            t as (select domain, seconds, {CATEGORY} as category from targets where seconds is not null and status <> 'ROBOTS_DENIED'),
            own as (select domain, category, count(*) as n, {COST} as own_cost from t group by all), over_ as (select category, {COST} as category_cost from t group by all), every_ as (select {COST} as any_cost from t),
            x as (select r.domain, r.k / w.sample_count * case when r.category = 'ROBOTS_DENIED' then 0.2 else
                coalesce(n / (n + 20.0), 0) * coalesce(own_cost, category_cost, any_cost) + (1 - coalesce(n / (n + 20.0), 0)) * coalesce(category_cost, any_cost) end as part, w.sample_count
                from rates r join whole w using (domain) left join own using (domain, category) left join over_ using (category), every_)
            select domain, any_value(n_urls) as n_urls, cast(max(sample_count) as bigint) as sample_count, round(sum(part), 6) as seconds_per_url, round(any_value(n_urls) * sum(part), 4) as estimated_work from x join total using (domain) group by domain""",
        "risk_scores": f"with {RISK} select doc_id, domain, text_chars, risk, list_aggregate(list_sort(reasons), 'string_agg', ',') as reasons from scored",
        "risk_summary": f"""with {RISK}, ranked as (select *, row_number() over (partition by domain order by risk) as rn, count(*) over (partition by domain) as n from scored)
            select domain, count(*) as n_docs, round(avg(risk), 6) as mean_risk, min(risk) filter (rn = 1 + floor((n - 1) * 0.5)) as p50_risk, min(risk) filter (rn = 1 + floor((n - 1) * 0.9)) as p90_risk, max(risk) as max_risk,
            count(*) filter (list_contains(reasons, 'very_short_text')) as n_very_short_text, count(*) filter (list_contains(reasons, 'duplicate_content')) as n_duplicate_content,
            count(*) filter (list_contains(reasons, 'missing_title')) as n_missing_title, count(*) filter (list_contains(reasons, 'missing_language')) as n_missing_language, count(*) filter (list_contains(reasons, 'boilerplate_markers')) as n_boilerplate_markers,
            count(*) filter (list_contains(reasons, 'very_low_text_ratio')) as n_very_low_text_ratio, count(*) filter (list_contains(reasons, 'title_body_mismatch')) as n_title_body_mismatch from ranked group by domain""",
        "hash_sample": f"with d as (select distinct doc_id, domain from corpus) select domain, doc_id, {stable_int('doc_id', 7)} as score, cast(row_number() over (partition by domain order by {stable_int('doc_id', 7)}, doc_id) as integer) as rank_in_group from d qualify rank_in_group <= 20",
        "review_interleave": f"with d as (select distinct doc_id, domain, content_type from corpus where crawl_status = 'SUCCESS') select domain, content_type, doc_id, cast(row_number() over (partition by coalesce(domain, ''), coalesce(content_type, '') order by {stable_int('doc_id', 7)}, doc_id) as integer) as turn from d qualify turn <= 50",
        "spread_sample": "with d as (select distinct doc_id, domain, length(text) as n from corpus where text is not null), r as (select *, row_number() over (partition by domain order by n, doc_id) as place, count(*) over (partition by domain) as of_ from d) select domain, doc_id, cast(n as integer) as n, cast(place as integer) as place from r where list_contains([1 + floor(i * (of_ - 1) / 4) for i in range(5)], place)",
        "clean_hashes": f"select doc_id, sha256({clean('text')}) as content_hash from documents where text is not null",
        "token_counts": f"select doc_id, {token_count('text')} as n_tokens, len({tokens('text')}) as n_terms from documents where text is not null",
        "first_words": f"select doc_id, array_to_string(regexp_split_to_array({strip('text')}, '{WS}+')[1:20], ' ') as head, {dedup_form('title')} as title_form from documents where text is not null",
        "merge_winners": f"select doc_id, url, crawl_status, text_chars, content_hash from corpus qualify {best} = 1",
        "merge_conflicts": "with v as (select distinct doc_id, url, crawl_status, content_hash from corpus) select doc_id, count(*) as n_versions, count(distinct url) as n_urls, count(distinct crawl_status) as n_statuses from v group by doc_id having count(*) > 1",
        "recovery_states": """with u as (select doc_id, l.status as crawl_status, cast(epoch_us(logged_at) as bigint) as n from timing_log l join crawl_tasks t using (fetch_key)), b as (select doc_id, status as crawl_status, cast(-1 as bigint) as n from crawl_tasks)
            select doc_id, crawl_status from (select * from u union all select * from b) qualify row_number() over (partition by doc_id order by (crawl_status = 'SUCCESS') desc, n desc, crawl_status desc) = 1""",
        "prune_corpus": f"select doc_id, url, text_chars, length(text) as n_chars from corpus where crawl_status = 'SUCCESS' and length(text) >= 50 and doc_id in (select doc_id from crawl_tasks) qualify {best} = 1",
        "missing_delta": "select doc_id, cast(doc_id % 2 as integer) as part from (select distinct doc_id from crawl_tasks) where doc_id not in (select doc_id from corpus where crawl_status = 'SUCCESS' and length(text) >= 50)",
        "corpus_checks": f"""with v as (select 'no task' as "check", 'error' as severity, doc_id as key, '' as detail from (select distinct doc_id from corpus) where doc_id not in (select doc_id from crawl_tasks)
            union all select 'no row', 'error', doc_id, status from crawl_tasks where status in {PROFILED} and doc_id not in (select doc_id from corpus)
            union all select 'stale length', 'warning', doc_id, '' from (select distinct doc_id from corpus where text_chars <> coalesce(length(text), 0))
            union all select 'foreign status', 'warning', doc_id, crawl_status from (select distinct doc_id, crawl_status from corpus where crawl_status not in {PROFILED}))
            select "check", severity, cast(key as varchar) as key, detail from v""",
        "due_tasks": f"select doc_id, status, attempts from crawl_tasks where status = 'PENDING' or (status = 'RETRY_WAIT' and next_retry_at <= {NOW})",
        "fair_claim": f"with {READY} select fetch_key, domain, claim_no from claimed",
        "claimed_state": f"with {READY} select doc_id, case when c.fetch_key is not null then 'FETCHING' else status end as status, case when c.fetch_key is not null then attempts + 1 else attempts end as attempts from crawl_tasks t left join claimed c using (fetch_key)",
        "recovery_targets": "select doc_id, domain, status from crawl_tasks where domain = 'marrow-daily.test' or status in ('NEEDS_JS', 'FAILED') or (status = 'SUCCESS' and coalesce(text_chars, 0) < 200)",
        "fetch_metrics": "with d as (select distinct on (fetch_key, attempt, finished_at) * from timing_log) select cast(epoch(date_trunc('hour', finished_at)) as bigint) as window_start, domain, count(*) as n_attempts, count(*) filter (status = 'SUCCESS') as n_success, round(avg(elapsed_seconds), 9) as mean_seconds from d group by all",
        "bm25_topk": f"with {bm25('hits', {'title': 2.0, 'text': 1.0})} select * from hits",
        "bm25_levels": f"with {bm25('hits', {'title': 2.0, 'text': 1.0})} select cast(k as integer) as k, count(*) as n_hits, count(distinct doc_id) as n_docs, round(count(distinct doc_id) / count(*), 6) as unique_ratio from hits, (select unnest([1, 5, 10, 100, 1000]) as k) where rank <= k group by k",
        "bm25_union": f"with {bm25('hits', {'title': 2.0, 'text': 1.0})} select doc_id, count(*) as match_count, min(rank) as best_rank, max(score) as best_score, string_agg(cast(query_id as varchar), ',' order by query_id) as query_ids from hits group by doc_id",
        "dense_topk": f"with {DENSE} select query_id, vec_id, score, rank from dense",
        "dense_documents": f"""with {DENSE}, per as (select query_id, vec_id // 4 as doc_id, max(score) as score, arg_min(vec_id, rank) as best_chunk from dense group by all)
            select query_id, doc_id, score, best_chunk, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from per qualify rank <= 1000""",
        "dense_second": f"""with {DENSE}, h as (select query_id, vec_id // 4 as doc_id, vec_id % 4 as chunk_index, score from dense), f as (select *, first_value(chunk_index) over (partition by query_id, doc_id order by score desc, chunk_index) as first_index from h)
            select query_id, doc_id, min(first_index) as first_index, arg_min(chunk_index, row(-score, chunk_index)) as second_index from f where abs(chunk_index - first_index) >= 2 group by query_id, doc_id""",
        "rrf_fusion": f"with {two}{fused} select query_id, doc_id, lexical_rank, dense_rank, fused_score, final_rank from first",
        "rrf_stats": f"with {two}{fused} select count(*) as n_hits, count(*) filter (lexical_rank is not null and dense_rank is not null) as n_both, count(*) filter (dense_rank is null) as n_lexical_only, count(*) filter (lexical_rank is null) as n_dense_only from first",
        "wide_passages": rf"""with l as (select doc_id, chunk_index, text, row_number() over (partition by doc_id order by chunk_index) as place from (select doc_id, cast(unnest(range(len(string_split(text, chr(10))))) as integer) as chunk_index, unnest(string_split(text, chr(10))) as text from documents where text is not null) where trim(text, ' ') <> ''),
            o as (select * from (values (0, 0), (1, 1), (-1, 2), (2, 3), (-2, 4), (3, 5), (-3, 6), (4, 7), (-4, 8)) as t(far, turn)),
            j as (select a.doc_id, a.chunk_index, far, turn, b.text, len(regexp_split_to_array({strip("b.text")}, '{WS}+')) as n from l a, o, l b where b.doc_id = a.doc_id and b.place = a.place + far),
            k as (select *, coalesce(sum(n) over (partition by doc_id, chunk_index order by turn rows between unbounded preceding and 1 preceding), 0) as before from j)
            select doc_id, chunk_index, cast(sum(n) as integer) as n_words, cast(length(string_agg(text, ' ' order by far)) as integer) as n_chars from k where before < 60 group by all""",
        "extracted_pages": rf"""with d as (select doc_id, title, regexp_split_to_array(coalesce(text, ''), '\n+') as ls, lower(coalesce(title, '') || coalesce(text, '')) as low from documents),
            b as (select doc_id, title, low, list_filter(list_transform(ls, lambda x: trim(regexp_replace(x, '{PYTHON_WS}+', ' ', 'g'), ' ')), lambda x: x <> '') as bs from d),
            p as (select doc_id, low, nullif(trim(regexp_replace(coalesce(title, ''), '{PYTHON_WS}+', ' ', 'g'), ' '), '') as title, array_to_string(list_filter(bs, lambda x, i: i = 1 or x <> bs[i - 1]), chr(10) || chr(10)) as body from b)
            select doc_id, case when length({strip("body")}) >= 100 then 'SUCCESS' when contains(low, '__next_data__') or contains(low, 'id="__next"') or contains(low, 'id="root"') or contains(low, 'id="app"') or contains(low, 'enable javascript') or contains(low, 'requires javascript') then 'NEEDS_JS' else 'EMPTY_CONTENT' end as status,
            title, cast(nullif(length(body), 0) as integer) as n_chars from p""",
        "result_violations": """with q as (select doc_id as q, (doc_id // 50) % 10 as c from documents where doc_id % 50 = 0)
            select 'id is no integer' as "check", 'error' as severity, cast(q as varchar) as key, 'STRING' as detail from q where c = 1
            union all select 'document twice', 'error', cast(q as varchar), cast(q as varchar) from q where c in (2, 9)
            union all select 'query is missing', 'error', cast(q as varchar), '' from q where c = 3
            union all select 'chunk without text', 'error', cast(q as varchar), '0' from q where c = 4
            union all select 'prefix leaks', 'error', cast(q as varchar), '0' from q where c = 5
            union all select 'forbidden field', 'error', cast(q as varchar), 'score' from q where c = 6
            union all select 'chunk of no relevant document', 'warning', cast(q as varchar), cast(q + 7 as varchar) from q where c = 7
            union all select 'relevant_docs is no array', 'error', cast(q as varchar), '' from q where c = 8
            union all select 'chunk of no relevant document', 'warning', cast(q as varchar), cast(q as varchar) from q where c = 8
            union all select 'query twice', 'error', cast(q as varchar), '2' from q where c = 9
            union all select 'unknown query', 'error', '999999999', ''
            union all select 'document is not in the corpus', 'warning', '999999999', '-1'
            union all select 'not JSON', 'error', 'item 777', ''""",
        "neighbour_lines": "with l as (select doc_id, cast(unnest(range(len(string_split(text, chr(10))))) as integer) as chunk_index, unnest(string_split(text, chr(10))) as text from documents where text is not null) select a.doc_id, a.chunk_index, b.text as before, c.text as after from l a left join l b on a.doc_id = b.doc_id and a.chunk_index = b.chunk_index + 1 left join l c on a.doc_id = c.doc_id and a.chunk_index = c.chunk_index - 1",
        "archive_groups": """with r as (select l_suppkey as filename, l_orderkey * 1000 + l_linenumber as "offset", cast(l_quantity as bigint) as length from lineitem),
            e as (select *, max("offset" + length) over (partition by filename order by "offset", length rows between unbounded preceding and 1 preceding) as before_end from r),
            g as (select *, sum(case when "offset" - before_end <= 65536 then 0 else 1 end) over (partition by filename order by "offset", length rows between unbounded preceding and current row) as group_no from e)
            select filename, cast(group_no as bigint) as group_no, min("offset") as "offset", max("offset" + length) - min("offset") as length, count(*) as n_records from g group by filename, group_no""",
        "newest_captures": f"with k as (select regexp_replace({u}, '^https?://', '') as lookup_key, doc_id, url, attempts from crawl_tasks) select lookup_key, doc_id from k where lookup_key is not null qualify row_number() over (partition by lookup_key order by attempts desc, url desc, doc_id desc) = 1",
        "curated_texts": f"with {CURATED} select * from curated",
        "curation_stats": f"with {CURATED} select domain, count(*) as n_docs, count(*) filter (curation_status = 'CLEAN') as n_clean, cast(sum(removed_chars) as bigint) as removed_chars from curated group by domain",
        "pilot_sample": f"""with r as (select distinct on (doc_id) doc_id, url, {host('url')} as domain, lower({part('url', 3)}) like '%.pdf' as is_pdf, {stable_int('doc_id', 7)} as score from crawl_tasks where {host('url')} is not null),
            k as (select *, row_number() over (partition by domain, is_pdf order by score, doc_id) as turn from r qualify turn <= 15),
            p as (select * from k where is_pdf order by turn, domain, score, doc_id limit 20), o as (select * from k where not is_pdf), f as (select * from o order by score, doc_id limit 56),
            s as (select * from o where doc_id not in (select doc_id from f) order by turn, domain, score, doc_id limit 100),
            u as (select *, 'pdf' as part, 0 as place from p union all select *, 'proportional', 1 from f union all select *, 'spread', 2 from s),
            v as (select *, row_number() over (partition by domain order by place, turn, score, doc_id) as rd from u qualify rd <= 15)
            select doc_id, url, domain, is_pdf, part from v order by place, turn, domain, score, doc_id limit 100""",
        "audit_high_risk": f"with {RISK}, k as (select doc_id, domain, risk, sha256('audit:' || cast(doc_id as varchar)) as key from scored), r as (select *, row_number() over (partition by domain order by risk desc, key, doc_id) as rn from k qualify rn <= 10) select doc_id, domain, risk from r order by risk desc, key, doc_id limit 100",
        "settled_state": f"""with o as (select fetch_key, status as outcome, retryable from timing_log qualify row_number() over (partition by fetch_key order by status desc, retryable desc nulls last) = 1),
            t as (select *, outcome is not null and status in ('PENDING', 'FETCHING', 'RETRY_WAIT') as hit from crawl_tasks left join o using (fetch_key)), r as (select *, hit and coalesce(retryable, false) and attempts < 3 as again from t)
            select doc_id, case when again then 'RETRY_WAIT' when hit then outcome else status end as status, attempts,
            round(case when again then {NOW} + least(3600.0, 30 * pow(2, greatest(attempts, 1) - 1) + ({stable_int('fetch_key', 'retry')} % 1000) / 1000.0) when hit then null else next_retry_at end, 3) as next_retry_at from r""",
        "error_breakdown": r"with e as (select status, upper(regexp_replace(" + strip("coalesce(error_type, '')") + r", '[\s-]+', '_', 'g')) as error, http_status, count(*) as n from crawl_tasks group by all) select * from e order by n desc, status, error, http_status nulls first limit 30",
        "storage_projection": "select count(*) as n_tasks, count(*) filter (status = 'SUCCESS') as n_done, cast(sum(bytes_downloaded) filter (status = 'SUCCESS') as bigint) as bytes_done, cast(sum(text_chars) filter (status = 'SUCCESS') as bigint) as chars_done, round(sum(bytes_downloaded) filter (status = 'SUCCESS') * (count(*) / count(*) filter (status = 'SUCCESS')), 3) as bytes_projected from crawl_tasks",
        "slow_domains": "select domain, count(*) as n_attempts, round(avg(elapsed_seconds), 9) as mean_seconds from timing_log where elapsed_seconds is not null group by domain having count(*) >= 5 order by mean_seconds desc, domain limit 20",
        "failing_domains": "select domain, count(*) filter (status <> 'SUCCESS') as n_failed, count(*) as n_attempts from timing_log group by domain having count(*) filter (status <> 'SUCCESS') > 0 order by n_failed desc, domain limit 20",
        "robots_decisions": "select case when http_status is null then 'retry' when http_status between 200 and 299 then 'read' when http_status in (401, 403) then 'deny' when http_status between 400 and 499 then 'allow' when http_status between 520 and 529 then 'allow for an hour' else 'retry' end as decision, count(*) as n from crawl_tasks group by 1",
        "composition": r"""with f as (select doc_id, text, text as head from corpus where text is not null), g as (select distinct doc_id, length(text) >= 50 as has_text, case when length(text) < 20 then 'unknown'
            when length(regexp_replace(head, '[^\x{3400}-\x{9fff}]', '', 'g')) > 0.3 * length(regexp_replace(head, '[^\p{L}]', '', 'g')) then 'zh'
            when length(regexp_replace(lower(head), '[^ăâđêôơưàảãáạằẳẵắặầẩẫấậèẻẽéẹềểễếệìỉĩíịòỏõóọồổỗốộờởỡớợùủũúụừửữứựỳỷỹýỵ]', '', 'g')) > 0.05 * length(regexp_replace(head, '[^\p{L}]', '', 'g')) then 'vi'
            when length(regexp_replace(head, '[^\p{L}]', '', 'g')) > 0.4 * length(head) then 'en' else 'unknown' end as language_guess from f) select language_guess, has_text, count(*) as n_docs from g group by all""",
        "timing_gaps": f"""with l as (select fetch_key from timing_log where fetch_key not like 'a%' union all select 'unknown-' || fetch_key from timing_log where fetch_key like 'b0%') select 'no timing' as "check", 'error' as severity, fetch_key as key, '' as detail from (select fetch_key from crawl_tasks group by fetch_key having bool_or(status in {PROFILED})) where fetch_key not in (select fetch_key from l)
            union all select 'unknown target', 'error', fetch_key, '' from (select distinct fetch_key from l) where fetch_key not in (select fetch_key from crawl_tasks)""",
        "allocated_passages": f"""with {DENSE}, h as (select query_id, vec_id // 4 as doc_id, cast(vec_id % 4 as integer) as chunk_index, score from dense),
            d as (select query_id, doc_id, row_number() over (partition by query_id order by max(score) desc, doc_id) as doc_rank from h group by query_id, doc_id),
            b as (select *, first_value(chunk_index) over (partition by query_id, doc_id order by score desc, chunk_index) as best from h join d using (query_id, doc_id)),
            p as (select query_id, doc_id, doc_rank, chunk_index, case when doc_rank <= 25 then 1 else 3 end as part from b where chunk_index = best
                union all select query_id, doc_id, doc_rank, arg_min(chunk_index, row(-score, chunk_index)), 2 from b where doc_rank <= 25 and abs(chunk_index - best) >= 2 group by query_id, doc_id, doc_rank)
            select query_id, doc_id, chunk_index, cast(row_number() over (partition by query_id order by part, doc_rank, doc_id) as integer) as slot from p qualify slot <= 30""",
        "matched_captures": f"""with k as (select doc_id, url, attempts, regexp_replace({u}, '^https?://', '') as lookup_key from crawl_tasks),
            i as (select lookup_key, url as captured_from from k where attempts >= 2 and lookup_key is not null qualify row_number() over (partition by lookup_key order by attempts desc, url desc, doc_id desc) = 1)
            select doc_id, case when captured_from is not null then 'FOUND' else 'MISS' end as archive_status, captured_from from k left join i on coalesce(k.lookup_key, regexp_replace(k.url, '^https?://', '')) = i.lookup_key""",
        "token_spread": f"with t as (select {token_count('text')} as n from documents where text is not null) select count(*) as n, round(avg(n), 6) as mean, median(n) as median, cast(quantile_disc(n, 0.95) as double) as p95, min(n) as least, max(n) as most from t",
        "first_lines": "select source, doc_id, cast(row_number() over (partition by source order by doc_id) as integer) as place from documents qualify place <= 3",
    }
