"""DuckDB statements that the read queries must agree with.

Quotients are rounded half up in whole numbers, so no statement depends on
floating point sums.
"""

from __future__ import annotations

from .oracle_views import with_views


def quotient(num: str, den: str, digits: int) -> str:
    """``num / den`` rounded half up to ``digits`` (NULL when ``den`` is 0)."""
    n, d = f"cast({num} as hugeint)", f"nullif(cast({den} as hugeint), 0)"
    return f"cast(sign({n}) * ((2 * abs({n}) * {10**digits} + {d}) // (2 * {d})) as double) / {10**digits}"


def percent(num: str, den: str, digits: int = 1) -> str:
    return quotient(f"100 * ({num})", den, digits)


_GATED = """
    allowed as (select lo.rating_code as code, hi.rating_code as lim
                from content_rating_levels lo, content_rating_levels hi where {rule})"""
_ONE_SCALE = _GATED.format(rule="lo.sort_order <= hi.sort_order")
_TWO_SCALES = _GATED.format(rule="lo.sort_order <= hi.sort_order and lo.rating_system = hi.rating_system")
_AVG = quotient("sum(rating_value)", "count(rating_value)", 2)
_WATCHED = "watched_at between timestamp '1996-01-01' and timestamp '2000-12-31'"
_SEARCHED = "searched_at between timestamp '2024-01-03' and timestamp '2024-01-28'"
_KIDS_BROWSE = """,
    ranked as (
        select p.profile_id, c.*, row_number() over (
                   partition by p.profile_id order by c.release_date desc nulls first, c.content_id) as place
        from profiles p join allowed on lim = p.age_rating_limit
        join content c on c.age_certification = code and c.status = 'Active'
        where p.is_kids)
    select profile_id, content_id, title, poster_url, age_certification, content_type
    from ranked where place <= 10"""


def _money(expr: str) -> str:
    return f"cast({expr} as decimal(28,2))"


def _monthly_revenue(statuses: str) -> str:
    return f"""with m as (
        select cast(date_trunc('month', paid_at) as date) as revenue_month, sum(amount) as g,
               sum(refund_amount) as r
        from payments where payment_status in ({statuses}) and paid_at >= timestamp '1996-06-30' group by 1),
    n as (select *, cast((g - r) * 100 as hugeint) as net,
                 lag(cast((g - r) * 100 as hugeint)) over (order by revenue_month) as prev from m)
    select revenue_month, {_money('g')} as gross_revenue, {_money('r')} as total_refunded,
           {_money('g - r')} as net_revenue, {percent('net - prev', 'prev')} as net_revenue_growth_pct
    from n"""


def _conversion(minutes: int, limit: str) -> str:
    return f"""
    select s.search_query, count(distinct s.search_id) as total_searches,
           count(distinct w.watch_id) as resulting_watches,
           {percent('count(distinct w.watch_id)', 'count(distinct s.search_id)')} as conversion_rate_pct
    from search_history s left join watch_history w on w.profile_id = s.profile_id
         and w.watched_at >= s.searched_at and w.watched_at <= s.searched_at + interval {minutes} minute
    where s.{_SEARCHED} group by s.search_query
    order by total_searches desc, s.search_query {limit}"""


_LIKES = f"""
    select title, count(*) as total_ratings,
           {percent('count(*) filter (is_liked)', 'count(*)')} as like_pct
    from ratings join content using (content_id)
    where season_id is null and episode_id is null and part_id is null group by title"""

_UNFINISHED = """with u as (
        select *, row_number() over (partition by profile_id, content_id
                                     order by watched_at desc, watch_id desc) as latest
        from watch_history where not completed {more}),
    p as (select *, row_number() over (partition by profile_id order by content_id) as place
          from u where latest = 1)"""
_UNFINISHED_COLUMNS = f"""
    select p.profile_id, p.content_id, c.title, c.poster_url, c.content_type, p.episode_id,
           e.title as episode_title, p.progress_seconds, p.watch_duration_seconds,
           {quotient('100 * p.progress_seconds', 'p.watch_duration_seconds', 0)} as pct_complete, p.watched_at
    from p join content c using (content_id) left join episodes e on e.episode_id = p.episode_id"""

BODIES = {
    "r01_catalog_search": f"""with rated as (
        select content_id, {quotient('sum(rating_value)', 'count(rating_value)', 1)} as avg_rating,
               count(*) as rating_count
        from ratings group by content_id)
    select content_id, title, content_type, release_date, poster_url, age_certification, avg_rating,
           coalesce(rating_count, 0) as rating_count,
           cast(case when title ilike 'ring%' then 3 when title ilike '%ring%' then 2 else 1 end as int)
               as relevance_score
    from content left join rated using (content_id)
    where status = 'Active' and (title ilike '%ring%' or description ilike '%ring%')
    order by relevance_score desc, avg_rating desc nulls last, release_date desc nulls first, content_id
    limit 10""",
    "r02_search_count": """
    select count(*) as total_matches from content
    where status = 'Active' and concat_ws(chr(10), title, description) ilike '%ring%'""",
    "r03_autocomplete": """
    select title from content where status = 'Active' and title ilike 's%'
    group by title order by title limit 8""",
    "r04_titles_by_genre": f"""with rated as (
        select content_id, {quotient('sum(rating_value)', 'count(rating_value)', 1)} as avg_rating
        from ratings group by content_id)
    select genre_id, genre_name, content_id, title, content_type, poster_url, release_date, avg_rating
    from genres join content_genres using (genre_id) join content c using (content_id)
         left join rated using (content_id)
    where c.status = 'Active'
    qualify row_number() over (partition by genre_id order by release_date desc nulls first, content_id) <= 10""",
    "r04_titles_by_genre_next": f"""with rated as (
        select content_id, {quotient('sum(rating_value)', 'count(rating_value)', 1)} as avg_rating
        from ratings group by content_id)
    select genre_id, genre_name, content_id, title, content_type, poster_url, release_date, avg_rating
    from genres join content_genres using (genre_id) join content c using (content_id)
         left join rated using (content_id)
    where c.status = 'Active'
    qualify row_number() over (partition by genre_id order by release_date desc nulls first, content_id) between 11 and 20""",
    "r15_my_list_next": """
    select profile_id, my_list_id, content_id, title, poster_url, content_type, added_at
    from my_list join content using (content_id) where status = 'Active'
    qualify row_number() over (partition by profile_id order by added_at desc, content_id) between 3 and 4""",
    "r05_titles_with_all_genres": """
    select content_id, title, poster_url from content c
    where status = 'Active' and content_id in (select content_id from content_genres where genre_id = 1)
      and content_id in (select content_id from content_genres where genre_id = 4)
    order by release_date desc nulls first, content_id limit 10""",
    "r06_titles_by_language": """with d as (
        select distinct language_id, content_id, title, content_type, poster_url
        from content_languages join content using (content_id)
        where language_type <> 'Subtitle' and status = 'Active')
    select * from d qualify row_number() over (partition by language_id order by title, content_id) <= 10""",
    "r07_title_languages": """
    select content_id, language_name, language_code, language_type, is_default
    from content_languages join languages using (language_id)""",
    "r08_available_in": """
    select country_code, content_id, title, poster_url, available_from, available_to
    from content_availability join content using (content_id)
    where status = 'Active' and available_from <= date '2001-06-30'
      and coalesce(available_to, date '9999-12-31') > date '2001-06-30'
    qualify row_number() over (partition by country_code order by available_from desc, content_id) <= 10""",
    "r09_leaving_soon": """
    select country_code, content_id, title, poster_url, available_to
    from content_availability join content using (content_id)
    where status = 'Active' and available_to >= date '2001-06-30' and available_to <= date '2001-08-29'
    qualify row_number() over (partition by country_code order by available_to, content_id) <= 20""",
    "r10_resume_points": """
    select profile_id, content_id, episode_id, watch_id, progress_seconds, watch_duration_seconds, completed,
           watched_at
    from watch_history
    qualify row_number() over (partition by profile_id, content_id, episode_id
                               order by watched_at desc, watch_id desc) = 1""",
    "r11_continue_watching": _UNFINISHED.format(more="and progress_seconds > 0")
    + _UNFINISHED_COLUMNS
    + " where place <= 10",
    "r11_unfinished": _UNFINISHED.format(more="") + _UNFINISHED_COLUMNS,
    "r12_next_episode": """with e as (
        select e.*, s.content_id, s.season_number from episodes e join seasons s using (season_id))
    select e.episode_id, e.season_id, e.episode_number,
           case when n.episode_id is null then f.episode_id else n.episode_id end as next_episode_id,
           case when n.episode_id is null then f.title else n.title end as next_title,
           case when n.episode_id is null then f.season_id else n.season_id end as next_season_id
    from e left join e n on n.season_id = e.season_id and n.episode_number = e.episode_number + 1
    left join e f on f.content_id = e.content_id and f.season_number = e.season_number + 1
                     and f.episode_number = 1""",
    "r13_ratings_for": """
    select profile_id, content_id, rating_value, review_text, updated_at from ratings r
    where exists (select 1 from my_list m
                  where m.profile_id = r.profile_id and m.content_id = r.content_id)""",
    "r14_title_reviews": """
    select content_id, rating_id, rating_value, review_text, updated_at, profile_name
    from ratings join profiles using (profile_id) where trim(review_text) <> ''
    qualify row_number() over (partition by content_id order by updated_at desc, rating_id) <= 10""",
    "r14_title_reviews_gen2": """
    select content_id, rating_id, is_liked, review_text, r.created_at, profile_name
    from ratings r join profiles using (profile_id) where review_text is not null""",
    "r15_my_list_view": """
    select profile_id, my_list_id, content_id, title, poster_url, content_type, added_at
    from my_list join content using (content_id) where status = 'Active'
    qualify row_number() over (partition by profile_id order by added_at desc, content_id) <= 10""",
    "r15_my_list_all": """
    select profile_id, my_list_id, content_id, title, poster_url, content_type, added_at
    from my_list join content using (content_id)""",
    "r16_in_my_list": """
    select profile_id, content_id,
           (profile_id, content_id) in (select (profile_id, content_id) from my_list) as in_my_list
    from ratings""",
    "r17_download_quota": """
    select s.user_id, max_downloads,
           (select count(*) from downloads d join profiles p using (profile_id)
            where p.user_id = s.user_id and d.download_status = 'Active') as current_downloads
    from subscriptions s join subscription_plans using (plan_id) where s.status = 'active'""",
    "r18_device_downloads": f"""
    select profile_id, device_id, download_id, c.title, poster_url, d.episode_id, e.title as episode_title,
           file_size_mb, downloaded_at, expiry_date,
           {_money('sum(file_size_mb) over (partition by profile_id, device_id)')} as total_storage_used_mb
    from downloads d join content c using (content_id) left join episodes e on e.episode_id = d.episode_id
    where download_status = 'Active'""",
    "r19_profile_quota": """with n as (select user_id, count(*) as n from profiles group by 1)
    select user_id, max_profiles, coalesce(n, 0) as current_profile_count,
           coalesce(n, 0) < max_profiles as can_create_more
    from subscriptions join subscription_plans using (plan_id) left join n using (user_id)
    where status = 'active'""",
    "r20_account_profiles": """
    select user_id, profile_id, profile_name, avatar_url, is_kids, is_primary,
           pin_hash is not null as is_pin_protected
    from profiles""",
    "r21_billing_history": """
    select y.user_id, payment_id, amount, currency, payment_status, payment_method, invoice_url, paid_at,
           plan_name
    from payments y join subscriptions using (subscription_id) join subscription_plans using (plan_id)
    qualify row_number() over (partition by y.user_id order by y.created_at desc, payment_id) <= 10""",
    "r22_active_subscription": """
    select user_id, subscription_id, plan_name, price_monthly, price_yearly, billing_cycle, start_date,
           next_billing_date, auto_renew, status, trial_end_date,
           coalesce(trial_end_date >= date '2001-06-30', false) as is_in_trial
    from subscriptions join subscription_plans using (plan_id) where status = 'active'""",
    "r23_subscription_history": """
    select user_id, subscription_id, plan_name, status, start_date, end_date, cancellation_reason
    from subscriptions join subscription_plans using (plan_id)""",
    "r24_lookup_payments": "select * from payments where payment_status = 'refunded'",
    "r25_user_devices": "select user_id, device_id, os_type, device_type, last_active_at from user_devices",
    "r26_title_search": """
    select content_id, title, content_type, content_category, release_date, poster_url
    from content where status = 'Active' and title ilike '%ring%'""",
    "r27_content_detail": """
    select content_id, title, description, content_type, content_category, release_date, duration_minutes,
           poster_url, trailer_url,
           (select coalesce(list(genre_name order by genre_name), []) from content_genres g
            join genres using (genre_id) where g.content_id = c.content_id) as genres
    from content c""",
    "r28_cast_list": """
    select content_id, actor_id, actor_name, photo_url, character_name, cast_order, is_main_cast
    from content_cast join actors using (actor_id)""",
    "r29_filmography": """
    select actor_id, content_id, title, poster_url, release_date, character_name
    from content_cast join content using (content_id) where status = 'Active'""",
    "r30_actor_search": """
    select actor_id, actor_name, date_of_birth, photo_url from actors where actor_name ilike '%9%'
    order by actor_name, actor_id limit 10""",
    "r31_admin_content_list": """
    select content_id, title, content_type, status, release_date, created_at, updated_at,
           (select count(*) from seasons s where s.content_id = c.content_id) as season_count,
           (select count(distinct actor_id) from content_cast k where k.content_id = c.content_id) as cast_count
    from content c""",
    "r31_admin_content_page": """
    select content_id, title, content_type, status, release_date, created_at, updated_at,
           (select count(*) from seasons s where s.content_id = c.content_id) as season_count,
           (select count(distinct actor_id) from content_cast k where k.content_id = c.content_id) as cast_count
    from content c where status = 'Active' and title ilike '%ring%'
    order by updated_at desc, content_id limit 10""",
    "r32_availability_matrix": """
    select content_id, country_code, available_from, available_to, region_notes,
           case when available_from > date '2001-06-30' then 'Scheduled'
                when available_to <= date '2001-06-30' then 'Expired' else 'Live' end as window_status
    from content_availability""",
    "r34_plan_impact": """
    select plan_id, count(subscription_id) as active_subscribers_on_plan
    from subscription_plans left join (select * from subscriptions where status = 'active') s using (plan_id)
    group by plan_id""",
    "r35_recent_watches": """
    select profile_id, watch_id, title, episode_id, watched_at, progress_seconds, completed
    from watch_history join content using (content_id)
    qualify row_number() over (partition by profile_id order by watched_at desc, watch_id desc) <= 8""",
    "r36_recent_searches": """
    select profile_id, search_query, searched_at, result_count from search_history
    qualify row_number() over (partition by profile_id order by searched_at desc, search_id desc) <= 8""",
    "r37_preferences": "select profile_id, audio_language, default_quality, ui_theme from profile_preferences",
    "r38_due_for_renewal": """
    select subscription_id, user_id, plan_id, billing_cycle from subscriptions
    where next_billing_date = date '2001-08-15' and status = 'active' and auto_renew""",
    "k01_kids_browse": "with" + _ONE_SCALE + _KIDS_BROWSE,
    "k01_kids_browse_per_system": "with" + _TWO_SCALES + _KIDS_BROWSE,
    "k02_effective_ceiling": """
    select profile_id, coalesce(sort_order, (select min(sort_order) from content_rating_levels))
               as effective_rating_ceiling
    from profiles left join content_rating_levels on rating_code = age_rating_limit""",
    "k03_playback_allowed": """
    select r.profile_id, r.content_id, coalesce(lo.sort_order <= hi.sort_order, false) as is_playback_allowed
    from ratings r left join profiles p on p.profile_id = r.profile_id
    left join content c on c.content_id = r.content_id
    left join content_rating_levels lo on lo.rating_code = c.age_certification
    left join content_rating_levels hi on hi.rating_code = p.age_rating_limit""",
    "k04_kids_genre_row": "with"
    + _ONE_SCALE
    + """
    select profile_id, genre_id, content_id, title, poster_url
    from profiles p join allowed on lim = p.age_rating_limit
    join content c on c.age_certification = code join content_genres using (content_id)
    where c.status = 'Active'
    qualify row_number() over (partition by profile_id, genre_id
                               order by release_date desc nulls first, content_id) <= 10""",
    "k05_kids_home": "with"
    + _ONE_SCALE
    + """
    select profile_id, genre_id, genre_name, content_id, title, poster_url,
           row_number() over (partition by profile_id, genre_id
                              order by release_date desc nulls first, content_id) as rank_in_row
    from profile_preferred_genres join genres using (genre_id) join profiles p using (profile_id)
    join allowed on lim = p.age_rating_limit join content_genres using (genre_id)
    join content c using (content_id)
    where c.age_certification = code and c.status = 'Active' qualify rank_in_row <= 10""",
    "k06_kids_fallback": "with"
    + _ONE_SCALE
    + f""",
    rated as (select content_id, {quotient('sum(rating_value)', 'count(rating_value)', 1)} as avg_rating
              from ratings group by content_id)
    select profile_id, c.content_id, title, poster_url, avg_rating
    from profiles p join allowed on lim = p.age_rating_limit join content c on c.age_certification = code
    left join rated on rated.content_id = c.content_id
    where c.status = 'Active' and profile_id not in (select profile_id from profile_preferred_genres)
    qualify row_number() over (partition by profile_id
                               order by avg_rating desc nulls last, c.content_id) <= 10""",
    "k07_kids_search": "with"
    + _ONE_SCALE
    + """
    select profile_id, content_id, title, poster_url, age_certification
    from profiles p join allowed on lim = p.age_rating_limit join content c on c.age_certification = code
    where c.status = 'Active' and c.title ilike '%ring%'
    qualify row_number() over (partition by profile_id order by title, content_id) <= 10""",
    "k08_kids_profiles": """
    select user_id, profile_id, profile_name, avatar_url, age_rating_limit,
           description as limit_description
    from profiles left join content_rating_levels on rating_code = age_rating_limit where is_kids""",
    "a01_title_engagement": f"""
    select content_id, title, content_type, count(*) as total_views, count(*) filter (completed) as completed_views,
           {percent('count(*) filter (completed)', 'count(*)')} as completion_rate_pct,
           {quotient('sum(watch_duration_seconds)', '60 * count(*)', 1)} as avg_minutes_watched,
           count(distinct profile_id) as unique_viewers
    from watch_history join content using (content_id) where {_WATCHED}
    group by all order by total_views desc, content_id limit 10""",
    "a02_daily_trend": f"""
    select content_id, cast(watched_at as date) as view_date, count(*) as views,
           count(distinct profile_id) as unique_viewers,
           {quotient('sum(watch_duration_seconds)', '60 * count(*)', 1)} as avg_minutes
    from watch_history where {_WATCHED} group by 1, 2""",
    "a03_episode_dropoff": f"""with v as (
        select s.content_id, s.season_number, e.episode_number, e.title as episode_title,
               count(w.watch_id) as total_views, count(w.watch_id) filter (w.completed) as completions
        from seasons s join episodes e using (season_id) left join watch_history w
             on w.episode_id = e.episode_id
        group by all),
    l as (select *, lag(total_views) over (partition by content_id, season_number
                                           order by episode_number) as prev from v)
    select content_id, season_number, episode_number, episode_title, total_views, completions,
           {percent('completions', 'total_views')} as completion_rate_pct,
           {percent('total_views', 'prev')} as pct_retained_from_prev_episode
    from l""",
    "a04_title_reach": f"""
    select content_id, title, count(distinct profile_id) as unique_viewers, count(*) as total_views,
           {quotient('count(*)', 'count(distinct profile_id)', 2)} as avg_views_per_viewer
    from watch_history join content using (content_id) where {_WATCHED}
    group by content_id, title order by unique_viewers desc, content_id limit 10""",
    "a05_genre_completion": f"""
    select genre_name, count(*) as total_views,
           {percent('count(*) filter (completed)', 'count(*)')} as completion_rate_pct
    from watch_history join content_genres using (content_id) join genres using (genre_id)
    where {_WATCHED} group by genre_name""",
    "a06_cancellations_mom": f"""with m as (
        select cast(date_trunc('month', cancelled_at) as date) as cancel_month, count(*) as cancellations
        from subscriptions where status = 'cancelled' and cancelled_at >= timestamp '1996-06-30' group by 1),
    l as (select *, lag(cancellations) over (order by cancel_month) as prev_month_cancellations from m)
    select *, {percent('cancellations - prev_month_cancellations', 'prev_month_cancellations')}
              as pct_change_mom
    from l""",
    "a07_cancellation_reasons": f"""with n as (
        select cancellation_reason, count(*) as occurrences from subscriptions where status = 'cancelled'
        group by 1)
    select coalesce(cancellation_reason, 'Not specified') as reason, occurrences,
           {percent('occurrences', '(select sum(occurrences) from n)')} as pct_of_total_cancellations
    from n""",
    "a08_cohort_churn": f"""
    select cast(date_trunc('month', start_date) as date) as cohort_month, count(*) as cohort_size,
           count(*) filter (status = 'cancelled') as cancelled_count,
           {percent("count(*) filter (status = 'cancelled')", 'count(*)', 2)} as churn_rate_pct
    from subscriptions group by 1""",
    "a09_plan_churn": f"""
    select plan_name, count(*) as total_subscriptions, count(*) filter (status = 'cancelled') as cancelled,
           {percent("count(*) filter (status = 'cancelled')", 'count(*)', 2)} as churn_rate_pct
    from subscriptions join subscription_plans using (plan_id)
    where start_date >= date '1996-01-01' and start_date <= date '2000-12-31' group by plan_name""",
    "a10_at_risk": """
    select user_id, email, plan_name, next_billing_date, end_date
    from users join subscriptions using (user_id) join subscription_plans using (plan_id)
    where status = 'active' and auto_renew = false""",
    "a11_monthly_revenue": _monthly_revenue("'completed'"),
    "a11_monthly_revenue_with_refunded": _monthly_revenue("'completed', 'refunded'"),
    "a12_plan_revenue": f"""with n as (
        select plan_name, count(*) as payment_count, sum(amount) as g, sum(refund_amount) as r
        from payments join subscriptions using (subscription_id) join subscription_plans using (plan_id)
        where payment_status = 'completed'
          and paid_at between timestamp '1996-01-01' and timestamp '2000-12-31'
        group by plan_name)
    select plan_name, payment_count, {_money('g')} as gross_revenue, {_money('r')} as total_refunded,
           {_money('g - r')} as net_revenue,
           {percent('(g - r) * 100', '(select sum(g - r) * 100 from n)')} as pct_of_total_revenue
    from n""",
    "a13_refund_stats": f"""
    select count(*) filter (refund_amount > 0) as refunded_payments, count(*) as total_payments,
           {percent('count(*) filter (refund_amount > 0)', 'count(*)', 2)} as refund_rate_pct,
           {quotient("sum(date_diff('second', paid_at, refunded_at))", '86400 * count(refunded_at)', 1)}
               as avg_days_to_refund
    from payments where payment_status in ('completed', 'refunded')""",
    "a14_failed_payments": """
    select y.user_id, email, payment_id, amount, payment_method, y.created_at, plan_name
    from payments y join users u on u.user_id = y.user_id join subscriptions using (subscription_id)
    join subscription_plans using (plan_id)
    where payment_status = 'failed'
      and y.created_at between timestamp '1996-01-01' and timestamp '2000-12-31'""",
    "a15_ltv": f"""
    select user_id, email, {_money('sum(amount) - sum(refund_amount)')} as lifetime_net_revenue,
           count(*) as total_payments, min(paid_at) as first_payment, max(paid_at) as last_payment
    from users join payments using (user_id) where payment_status = 'completed'
    group by user_id, email order by lifetime_net_revenue desc, user_id limit 10""",
    "a16_top_rated": f"""
    select content_id, title, content_type, count(*) as rating_count, {_AVG} as avg_rating
    from ratings join content using (content_id) group by all having count(*) >= 5
    order by avg_rating desc, rating_count desc, content_id limit 10""",
    "a17_weighted_rating": f"""with w as (select sum(rating_value) as s, count(*) as n from ratings)
    select content_id, title, count(*) as rating_count, {_AVG} as raw_avg_rating,
           {quotient('sum(rating_value) * max(n) + 10 * max(s)', 'max(n) * (10 + count(*))', 2)}
               as weighted_rating
    from ratings join content using (content_id) cross join w group by content_id, title
    order by weighted_rating desc, content_id limit 10""",
    "a18_top_rated_in_genre": f"""with v as (
        select genre_id, content_id, title, count(*) as rating_count, {_AVG} as avg_rating
        from content_genres join content using (content_id) join ratings using (content_id)
        group by all having count(*) >= 5)
    select * from v
    qualify row_number() over (partition by genre_id order by avg_rating desc, content_id) <= 10""",
    "a19_controversial": f"""
    select content_id, title, count(*) as rating_count, {_AVG} as avg_rating,
           round(stddev_samp(rating_value), 2) as rating_stddev
    from ratings join content using (content_id) group by content_id, title having count(*) >= 5
    order by rating_stddev desc nulls first, content_id limit 10""",
    "a20_search_top": f"""
    select search_query, count(*) as search_count,
           {quotient('sum(result_count)', 'count(*)', 1)} as avg_results_returned,
           count(distinct profile_id) as unique_searchers
    from search_history where {_SEARCHED} group by search_query
    order by search_count desc, search_query limit 10""",
    "a21_search_zero": f"""
    select search_query, count(*) as times_searched from search_history
    where {_SEARCHED} and result_count = 0 group by search_query
    order by times_searched desc, search_query limit 10""",
    "a22_search_conversion": _conversion(30, "limit 25"),
    "a22_search_conversion_day": _conversion(1440, ""),
    "a23_trending_searches": f"""with w as (
        select search_query, count(*) filter (searched_at >= timestamp '2024-01-24') as this_week_searches,
               count(*) filter (searched_at < timestamp '2024-01-24') as last_week_searches
        from search_history where searched_at >= timestamp '2024-01-17' group by 1)
    select *, {percent('this_week_searches - last_week_searches', 'last_week_searches')} as pct_growth_wow
    from w where this_week_searches >= 5 order by pct_growth_wow desc nulls last, search_query limit 25""",
    "a24_exec_dashboard": f"""
    select (select count(*) from users
            where created_at between timestamp '1996-01-01' and timestamp '2000-12-31') as new_users,
           (select count(*) from subscriptions
            where start_date between date '1996-01-01' and date '2000-12-31') as new_subscriptions,
           (select count(*) from subscriptions
            where cancelled_at between timestamp '1996-01-01' and timestamp '2000-12-31') as cancellations,
           (select {_money('coalesce(sum(amount) - sum(refund_amount), 0)')} from payments
            where payment_status = 'completed'
              and paid_at between timestamp '1996-01-01' and timestamp '2000-12-31') as net_revenue,
           (select count(*) from watch_history where {_WATCHED}) as total_views,
           (select count(distinct profile_id) from watch_history where {_WATCHED}) as active_viewers,
           (select {_AVG} from ratings where created_at between timestamp '1996-01-01'
                                                           and timestamp '2000-12-31') as avg_new_rating""",
    "b01_top_watched": """
    select content_id, any_value(title) as title, count(*) as view_count
    from watch_history join content using (content_id) group by content_id
    order by view_count desc, content_id limit 10""",
    "b02_genre_hours": f"""
    select genre_name, {quotient('sum(watch_duration_seconds)', '3600', 2)} as total_hours_watched
    from genres join content_genres using (genre_id) join watch_history using (content_id)
    group by genre_name""",
    "b03_mrr_by_plan": f"""
    select plan_name, count(*) as active_subscribers, {_money('sum(price_monthly)')} as mrr
    from subscription_plans join subscriptions using (plan_id)
    where status = 'active' and billing_cycle = 'monthly' group by plan_name""",
    "b04_total_mrr": f"""
    select {_money('sum(price_monthly)')} as total_mrr from subscription_plans join subscriptions using (plan_id)
    where status = 'active' and billing_cycle = 'monthly'""",
    "b05_arr_by_plan": f"""
    select plan_name, {_money("sum(if(billing_cycle = 'yearly', price_yearly, 12 * price_monthly))")} as arr
    from subscription_plans join subscriptions using (plan_id) where status = 'active' group by plan_name""",
    "b06_churned_users": """
    select count(distinct user_id) as churned_users from subscriptions
    where status = 'cancelled' and cancelled_at >= timestamp '2001-05-31'""",
    "b07_churn_rate": f"""with n as (
        select count(distinct user_id) filter (status = 'cancelled' and cancelled_at >= timestamp '2001-05-31')
                   as churned,
               count(distinct user_id) filter (start_date <= date '2001-05-31') as base
        from subscriptions)
    select churned, base, {percent('churned', 'base', 2)} as churn_rate_pct from n""",
    "b08_completion_by_title": f"""
    select title, {percent('count(*) filter (completed)', 'count(*)')} as completion_rate_pct,
           count(*) as total_sessions
    from watch_history join content using (content_id) group by title""",
    "b09_unwatched_content": """
    select content_id, title, release_date from content
    where status = 'Active' and content_id not in (select content_id from watch_history)""",
    "b10_like_pct": _LIKES,
    "b11_most_disliked": _LIKES,
    "b12_device_types": "select device_type, count(*) as device_count from user_devices group by all",
    "b13_os_types": "select os_type, count(os_type) as device_count from user_devices group by 1 having os_type <> ''",
    "b14_revenue_by_method": f"""
    select payment_method, {_money('sum(amount)')} as total_amount, count(*) as transaction_count
    from payments where payment_status = 'completed' group by all""",
    "b15_plan_distribution": f"""with n as (
        select plan_name, count(*) as active_subscribers
        from subscription_plans join subscriptions using (plan_id) where status = 'active' group by 1)
    select *, {percent('active_subscribers', '(select sum(active_subscribers) from n)')} as pct_of_active_base
    from n""",
    "b16_status_breakdown": "select status, count(*) as subscription_count from subscriptions group by all",
    "b17_at_profile_limit": """
    select user_id, plan_name, count(*) as profile_count, max_profiles
    from profiles join subscriptions using (user_id) join subscription_plans using (plan_id)
    where status = 'active' group by user_id, plan_name, max_profiles having count(*) >= max_profiles""",
    "b18_signups_monthly": """
    select cast(date_trunc('month', created_at) as date) as signup_month, count(*) as new_users
    from users where created_at >= timestamp '2000-06-30' group by 1""",
    "b19_top_searches": """
    select search_query, count(*) as times_searched from search_history group by 1
    order by times_searched desc, search_query limit 20""",
    "b20_availability_by_country": """
    select country_code, count(distinct content_id) as titles_available from content_availability
    where date '2001-06-30' between available_from and coalesce(available_to, date '9999-12-31')
    group by country_code""",
    "b21_titles_per_genre": """
    select genre_name, count(content_id) as title_count
    from genres left join content_genres using (genre_id) group by genre_name""",
    "b22_titles_per_category": """
    select coalesce(content_category, 'Uncategorized') as content_category, count(*) as title_count
    from content group by 1""",
    "b23_download_adoption": f"""with n as (
        select (select count(distinct profile_id) from downloads) as d, (select count(*) from profiles) as p)
    select d as profiles_with_downloads, p as total_profiles, {percent('d', 'p')} as adoption_pct from n""",
    "b24_category_performance": f"""
    select content_category, {quotient('sum(watch_duration_seconds)', '3600', 2)} as total_hours_watched,
           count(distinct content_id) as titles_in_category
    from content join watch_history using (content_id) where content_category <> '' group by 1""",
    "b25_failed_payment_totals": f"""
    select count(*) as failed_payment_count, {_money('sum(amount)')} as failed_payment_value
    from payments where payment_status = 'failed' and created_at >= timestamp '2001-05-31'""",
    "b26_optout_rate": f"""
    select count(*) filter (not auto_renew) as opted_out, count(*) as total_active,
           {percent('count(*) filter (not auto_renew)', 'count(*)')} as opt_out_rate_pct
    from subscriptions where status = 'active'""",
    "b27_favourite_genre": """with s as (
        select profile_id, genre_name, cast(sum(watch_duration_seconds) as bigint) as total_seconds
        from watch_history join content_genres using (content_id) join genres using (genre_id) group by 1, 2)
    select * from s
    qualify row_number() over (partition by profile_id order by total_seconds desc, genre_name) = 1""",
    "b28_listed_unwatched": """
    select profile_id, title, added_at from my_list m join content using (content_id)
    where not exists (select 1 from watch_history w
                      where w.profile_id = m.profile_id and w.content_id = m.content_id)""",
    "b29_profiles_per_user": f"""
    select {quotient('(select count(*) from profiles)', '(select count(*) from users)', 2)}
               as avg_profiles_per_user""",
    "b30_devices_per_user": f"""
    select {quotient('(select count(*) from user_devices)', '(select count(*) from users)', 2)}
               as avg_devices_per_user""",
    "b31_top_actors": """
    select actor_id, actor_name, count(distinct content_id) as title_count
    from content_cast join actors using (actor_id) group by actor_id, actor_name
    order by title_count desc, actor_id limit 10""",
    "b32_releases_monthly": """
    select cast(date_trunc('month', release_date) as date) as release_month, count(*) as titles_released
    from content where release_date is not null group by 1""",
}


#: The same rows for the keys that a screen asks for.
ASKED = {
    "r15_my_list_hot": ("r15_my_list_view", "true"),
    "b27_favourite_genre_hot": ("b27_favourite_genre", "true"),
    "r10_resume_points_kept": ("r10_resume_points", "true"),
    "r11_continue_watching_kept": ("r11_continue_watching", "true"),
    "r35_recent_watches_kept": ("r35_recent_watches", "true"),
    "r36_recent_searches_kept": ("r36_recent_searches", "true"),
    "r15_my_list_asked": ("r15_my_list_view", "profile_id in (select profile_id from profiles where is_kids)"),
    "r21_billing_history_asked": ("r21_billing_history", "user_id in (select user_id from users where account_status = 'active')"),
    "r25_user_devices_asked": ("r25_user_devices", "user_id in (select user_id from users where account_status = 'active')"),
    "r10_resume_points_asked": ("r10_resume_points", """exists (select 1 from downloads d where d.profile_id = r.profile_id
        and d.content_id = r.content_id and d.episode_id is not distinct from r.episode_id)"""),
    "r11_continue_watching_asked": ("r11_continue_watching", "profile_id in (select profile_id from profiles where is_kids)"),
    "r28_cast_list_asked": ("r28_cast_list", "content_id in (select content_id from content where status = 'Active')"),
    "k04_one_genre": ("k04_kids_genre_row", "genre_id = 4"),
}


def statements() -> dict[str, str]:
    asked = {name: f"select * from ({BODIES[whole]}) r where {wanted}" for name, (whole, wanted) in ASKED.items()}
    return {name: with_views(body) for name, body in {**BODIES, **asked}.items()}
