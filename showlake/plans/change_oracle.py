"""DuckDB statements for the change and quality queries."""

from __future__ import annotations

from ..operators import quality
from . import seeded
from .change_queries import SEEDED, quality_rules
from .oracle_views import with_views

# Columns of the derived tables, for the rules that can be checked on them.
DERIVED_COLUMNS = {
    "genres": "genre_id genre_name".split(),
    "languages": "language_id language_name language_code".split(),
    "actors": "actor_id actor_name date_of_birth photo_url".split(),
    "content": "content_id title description content_type content_category release_date age_certification duration_minutes status poster_url trailer_url created_at updated_at".split(),
    "seasons": "season_id content_id season_number".split(),
    "episodes": "episode_id season_id episode_number title".split(),
    "content_parts": "part_id content_id part_number".split(),
    "content_genres": "content_id genre_id".split(),
    "content_languages": "content_language_id content_id language_id language_type is_default".split(),
    "content_cast": "cast_id content_id actor_id character_name cast_order is_main_cast".split(),
    "content_availability": "availability_id content_id country_code available_from available_to region_notes".split(),
    "users": "user_id email full_name country_code account_status email_verified created_at".split(),
    "profiles": "profile_id user_id profile_name avatar_url is_kids is_primary age_rating_limit pin_hash created_at".split(),
    "subscription_plans": "plan_id plan_name price_monthly price_yearly max_profiles max_downloads is_active".split(),
    "plan_allowed_devices": "plan_id device_type".split(),
    "subscriptions": "subscription_id user_id plan_id status billing_cycle start_date end_date next_billing_date auto_renew cancelled_at cancellation_reason trial_end_date".split(),
    "payments": "payment_id transaction_id currency subscription_id user_id amount payment_method payment_status refund_amount paid_at refunded_at invoice_url created_at".split(),
    "user_devices": "device_id user_id os_type device_type last_active_at".split(),
    "ratings": "rating_id profile_id content_id season_id episode_id part_id rating_value is_liked review_text created_at updated_at".split(),
    "watch_history": "watch_id profile_id content_id episode_id watched_at watch_duration_seconds progress_seconds completed".split(),
    "my_list": "my_list_id profile_id content_id added_at".split(),
    "downloads": "download_id profile_id content_id episode_id device_id downloaded_at expiry_date file_size_mb download_status".split(),
    "search_history": "search_id profile_id search_query searched_at result_count".split(),
    "profile_preferences": "preference_id profile_id audio_language default_quality ui_theme".split(),
    "profile_preferred_genres": "profile_id genre_id".split(),
    "content_rating_levels": "rating_code rating_system sort_order description".split(),
}

_SUBSCRIPTION = """subscription_id, user_id, plan_id, status, billing_cycle, start_date, end_date,
           next_billing_date, auto_renew, cancelled_at, cancellation_reason, trial_end_date"""

BODIES = {
    "d01_merge_upsert": """with n as (
        select profile_id, content_id, cast(count(*) % 5 + 1 as smallint) as stars, max(watched_at) as t
        from watch_history where completed group by 1, 2)
    select coalesce(r.rating_id, 'w-' || cast(n.profile_id as varchar) || '-' || cast(n.content_id as varchar))
               as rating_id,
           coalesce(r.profile_id, n.profile_id) as profile_id, coalesce(r.content_id, n.content_id) as content_id,
           coalesce(stars, rating_value) as rating_value,
           case when stars is null then review_text else 'seen' end as review_text,
           case when stars is null then r.updated_at when r.rating_id is null then t
                else timestamp '2001-06-30' end as updated_at
    from ratings r full join n on n.profile_id = r.profile_id and n.content_id = r.content_id""",
    "d01_merge_upsert_null_safe": """with n as (
        select profile_id, content_id, episode_id, count(*) % 2 = 0 as liked, max(watched_at) as t
        from watch_history where completed group by all)
    select coalesce(r.rating_id, concat_ws('-', 'w', n.profile_id, n.content_id, n.episode_id)) as rating_id,
           coalesce(r.profile_id, n.profile_id) as profile_id, coalesce(r.content_id, n.content_id) as content_id,
           season_id, coalesce(r.episode_id, n.episode_id) as episode_id, part_id,
           coalesce(liked, is_liked) as is_liked,
           case when n.profile_id is null then r.updated_at when r.rating_id is null then t
                else timestamp '2001-06-30' end as updated_at
    from ratings r full join n on n.profile_id = r.profile_id and n.content_id = r.content_id
         and coalesce(n.episode_id, -1) = coalesce(r.episode_id, -1) and r.season_id is null and r.part_id is null""",
    "d02_insert_ignore_null_safe": """with a as (select actor_id, actor_name, date_of_birth from actors),
    n as (select -actor_id - 1 as actor_id, actor_name, date_of_birth from a where actor_id % 2 = 0
          union all
          select distinct null, character_name, null from content_cast)
    from a union all
    select min(actor_id), actor_name, date_of_birth from n
    where not exists (select 1 from a where a.actor_name = n.actor_name
                      and a.date_of_birth is not distinct from n.date_of_birth)
    group by actor_name, date_of_birth""",
    "d03_guarded_rows": """
    select 'search_history' as "table", cast(search_id as varchar) as id,
           search_id % 7 > 1 and trim(search_query) <> '' as accepted from search_history
    union all select 'watch_history', cast(watch_id as varchar), progress_seconds >= 600 and watch_duration_seconds >= 0
    from watch_history
    union all select 'content', cast(content_id as varchar), content_type = 'Movie' or content_id % 2 = 1 from content""",
    "d05_title_rows": """with m as (select content_id, title || ' ' || content_id as title from content where content_type = 'Movie')
    select title, 'genre' as kind, g as child, null::varchar as language_type, null::boolean as is_default
    from (select title, content_id % 11 + 1 as g from m union select title, content_id % 3 + 1 from m)
    union all select title, 'track', 1, 'Audio', true from m
    union all select title, 'track', 2, 'Subtitle', false from m""",
    "d05_title_ids": """with n as (select count(*) as n from content where content_type = 'Movie')
    select 'content' as "table", n as rows, n as ids, top + 1 as first_id, top + n as last_id
    from n, (select max(content_id) as top from content)
    union all select 'content_languages', 2 * n, 2 * n, top + 1, top + 2 * n
    from n, (select max(content_language_id) as top from content_languages)""",
    "d05_create_profiles": """
    select user_id, 'guest of ' || user_id as profile_name, false as is_kids, false as is_primary,
           'en' as audio_language, 'auto' as default_quality, 'dark' as ui_theme from users""",
    "d06_replaced_rows": """
    select profile_id, genre_id, -1 as sign from profile_preferred_genres join profiles using (profile_id) where is_kids
    union all
    (select distinct w.profile_id, g.genre_id, 1 from watch_history w join content_genres g using (content_id)
     join profiles p on p.profile_id = w.profile_id and is_kids where genre_id in (select genre_id from genres))""",
    "d07_toggled_rows": """with p as (
        select profile_id, content_id, min(downloaded_at) as added_at from downloads group by all)
    select m.* , -1 as sign from (select my_list_id, profile_id, content_id, added_at from my_list) m
    where (profile_id, content_id) in (select (profile_id, content_id) from p)
    union all
    select null, profile_id, content_id, added_at, 1 from p
    where (profile_id, content_id) not in (select (profile_id, content_id) from my_list)""",
    "d08_reinstate": """
    select * replace ('Active' as status, timestamp '2001-06-30' as updated_at)
    from content where status = 'Inactive' and content_id % 2 = 0""",
    "d08_remove_downloads": """
    select download_id, profile_id, content_id, episode_id, device_id, downloaded_at, expiry_date, file_size_mb,
           case when device_id % 2 = 0 then 'Deleted' else download_status end as download_status from downloads""",
    "d08_record_progress": """with w as (
        select *, progress_seconds * 2 > watch_duration_seconds as half, watch_duration_seconds < 600 as longer
        from watch_history where not completed)
    select * exclude (half, longer) replace (
        case when half then watch_duration_seconds else progress_seconds end as progress_seconds,
        case when longer then watch_duration_seconds * 2 else watch_duration_seconds end as watch_duration_seconds,
        half as completed)
    from w where half or longer""",
    "d08_close_windows": """
    select * replace (date '2001-06-30' as available_to) from content_availability
    where country_code = 'US' and available_from < date '2001-06-30' and coalesce(available_to > date '2001-06-30', true)""",
    "d08_ping_devices": """
    select d.* replace (case when s.t > coalesce(last_active_at, timestamp '0001-01-01') then s.t else last_active_at end as last_active_at)
    from user_devices d left join (select device_id, max(downloaded_at) as t from downloads group by 1) s using (device_id)""",
    "d08_set_ceiling": """
    select * replace (case when is_kids and user_id % 2 = 0 then 'PG' else age_rating_limit end as age_rating_limit) from profiles""",
    "d08_preferences": """
    select p.* replace (case when is_kids and p.profile_id % 2 = 0 then 'low' else default_quality end as default_quality,
                        case when is_kids then 'light' else ui_theme end as ui_theme)
    from profile_preferences p left join (select profile_id, is_kids from profiles) using (profile_id)""",
    "d02_insert_ignore": """with n as (
        select 'n-' || watch_id as my_list_id, profile_id, content_id, watched_at as added_at
        from watch_history where not completed
        qualify row_number() over (partition by profile_id, content_id order by watched_at, watch_id) = 1)
    select my_list_id, profile_id, content_id, added_at from my_list
    union all
    select my_list_id, profile_id, content_id, added_at from n
    where (profile_id, content_id) not in (select (profile_id, content_id) from my_list)""",
    "d02_insert_ignore_partial": """with n as (
        select 'again-' || download_id as download_id, profile_id, content_id, episode_id, device_id, downloaded_at,
               expiry_date, file_size_mb,
               case download_status when 'Expired' then 'Active' else 'Deleted' end as download_status
        from downloads where episode_id is null)
    select * from n where download_status = 'Deleted'
    union all
    select * from (select * from n where download_status = 'Active'
                   qualify row_number() over (partition by profile_id, content_id, device_id
                                              order by downloaded_at, download_id) = 1) f
    where not exists (select 1 from downloads d
                      where d.download_status = 'Active' and d.episode_id is null
                        and d.profile_id = f.profile_id and d.content_id = f.content_id
                        and d.device_id = f.device_id)""",
    "d03_append_valid": """
    select rating_id, review_text, coalesce(trim(review_text), '') <> '' as accepted from ratings""",
    "d04_insert_rows": """
    select 'pending' as account_status, false as email_verified, timestamp '2024-01-31' as created_at,
           count(*) as rows, count(*) as ids, (select max(user_id) from users) + 1 as first_id,
           (select max(user_id) from users) + count(*) as last_id
    from search_history""",
    "d05_create_titles": """
    select genre_id, count(*) as titles
    from (select content_id, content_id % 11 + 1 as genre_id from content where content_type = 'Movie'
          union select content_id, content_id % 3 + 1 from content where content_type = 'Movie')
    group by genre_id""",
    "d05_expand_insert": """
    select content_id, release_date as available_from, unnest(['US', 'IN', 'GB']) as country_code
    from content where release_date is not null""",
    "d06_replace_children": """
    select g.profile_id, g.genre_id from profile_preferred_genres g join profiles p using (profile_id)
    where not is_kids
    union
    select w.profile_id, g.genre_id from watch_history w join content_genres g using (content_id)
    join profiles p on p.profile_id = w.profile_id and is_kids
    where genre_id in (select genre_id from genres)""",
    "d07_toggle": """with p as (
        select profile_id, content_id, min(downloaded_at) as added_at from downloads group by all)
    select m.my_list_id, coalesce(m.profile_id, p.profile_id) as profile_id,
           coalesce(m.content_id, p.content_id) as content_id, coalesce(m.added_at, p.added_at) as added_at
    from my_list m full join p on p.profile_id = m.profile_id and p.content_id = m.content_id
    where m.my_list_id is null or p.profile_id is null""",
    "d08_expire_downloads": """
    select download_id, profile_id, content_id, episode_id, device_id, downloaded_at, expiry_date, file_size_mb,
           case when download_status = 'Active' and expiry_date < date '2001-06-30' then 'Expired'
                else download_status end as download_status
    from downloads""",
    "d08_cancel": """
    select * exclude (hit) replace (
           case when hit then 'cancelled' else status end as status, auto_renew and not hit as auto_renew,
           case when hit then timestamp '2001-06-30' else cancelled_at end as cancelled_at,
           case when hit then 'not renewed' else cancellation_reason end as cancellation_reason,
           case when not hit then next_billing_date end as next_billing_date)
    from (select *, status = 'active' and not auto_renew as hit from subscriptions)""",
    "d08_patch": """with n as (
        select content_id, min(character_name) as d, bool_or(cast_order is null) as fresh
        from content_cast where is_main_cast group by 1)
    select c.* replace (coalesce(d, description) as description,
                        case when fresh then 'trailer/new' else trailer_url end as trailer_url,
                        case when d is null then updated_at else timestamp '2001-06-30' end as updated_at)
    from content c left join n using (content_id)""",
    "d09_renew": """
    select * replace (
           case when status = 'active' and auto_renew and next_billing_date = date '2001-08-30'
                then cast(next_billing_date + case billing_cycle when 'yearly' then interval 1 year
                                              else interval 1 month end as date)
                else next_billing_date end as next_billing_date)
    from subscriptions""",
    "d08_verify_email": """
    select * exclude (hit) replace (email_verified or hit as email_verified,
           case when hit then 'active' else account_status end as account_status)
    from (select *, account_status = 'pending' and user_id % 2 = 0 as hit from users)""",
    "d08_pause": """
    select * replace (case when status = 'active' and auto_renew then 'paused' else status end as status)
    from subscriptions""",
    "d08_resume": """
    select * replace ('active' as status, date '2001-07-30' as next_billing_date)
    from subscriptions where status = 'paused' and user_id % 2 = 0""",
    "d08_retire": """
    select * replace ('Inactive' as status, timestamp '2001-06-30' as updated_at)
    from content where release_date is null""",
    "d09_renew_monthly": """
    select * replace (date '2001-09-30' as next_billing_date) from subscriptions
    where status = 'active' and auto_renew and next_billing_date = date '2001-08-30'""",
    "d13_set_null": """
    select * replace (case when episode_id % 3 <> 0 then episode_id end as episode_id) from watch_history""",
    "d14_delete_where": "select * from search_history where result_count = 0",
    "d09_apply_payments": """with p as (
        select search_id + 1 as subscription_id, result_count > 0 as done from search_history
        qualify row_number() over (partition by search_id // 2 order by 'p-' || cast(search_id as varchar)) = 1),
    n as (select subscription_id from p where done)
    select s.* replace (
           case when n.subscription_id is not null and billing_cycle = 'monthly'
                then cast(next_billing_date + interval 1 month as date) else next_billing_date end
           as next_billing_date)
    from subscriptions s left join n on n.subscription_id = s.subscription_id""",
    "d10_refund": """
    select * exclude (hit) replace (
           case when hit and refund_amount = 0 then amount
                when hit then cast(floor(amount * 100 / 2 + 0.5) / 100 as decimal(10,2))
                else refund_amount end as refund_amount,
           case when hit then 'refunded' else payment_status end as payment_status,
           case when hit then timestamp '2001-06-30' else refunded_at end as refunded_at)
    from (select *, payment_method = 'paypal' and payment_status = 'completed' as hit from payments)""",
    "d11_set_exclusive": """
    select * replace (profile_id = max(profile_id) filter (not is_kids) over (partition by user_id) as is_primary)
    from profiles""",
    "d12_change_plan": """with m as (
        select distinct user_id from profiles join watch_history using (profile_id) where completed)
    select user_id, plan_id, case when hit then 'expired' else status end as status, billing_cycle, start_date,
           case when hit then date '2001-06-30' else end_date end as end_date,
           case when not hit then next_billing_date end as next_billing_date
    from (select *, status = 'active' and user_id in (select user_id from m) as hit from subscriptions)
    union all
    select user_id, 3, 'active', 'monthly', date '2001-06-30', null, date '2001-07-30' from m""",
    "d13_delete_cascade": """with gone as (select content_id from content where status = 'Inactive'),
    bad_seasons as (select season_id from seasons where content_id in (from gone)),
    bad_episodes as (select episode_id from episodes where season_id in (from bad_seasons))
    select 'content' as "table", count(*) as rows from content where content_id not in (from gone)
    union all select 'seasons', count(*) from seasons where content_id not in (from gone)
    union all select 'episodes', count(*) from episodes where season_id not in (from bad_seasons)
    union all select 'content_parts', count(*) from content_parts where content_id not in (from gone)
    union all select 'content_genres', count(*) from content_genres where content_id not in (from gone)
    union all select 'content_languages', count(*) from content_languages where content_id not in (from gone)
    union all select 'content_cast', count(*) from content_cast where content_id not in (from gone)
    union all select 'content_availability', count(*) from content_availability
        where content_id not in (from gone)
    union all select 'ratings', count(*) from ratings where content_id not in (from gone)
        and coalesce(season_id not in (from bad_seasons), true)
        and coalesce(episode_id not in (from bad_episodes), true)
    union all select 'watch_history', count(*) from watch_history where content_id not in (from gone)
    union all select 'my_list', count(*) from my_list where content_id not in (from gone)
    union all select 'downloads', count(*) from downloads where content_id not in (from gone)""",
    "d13_rows_left": """with gone as (select content_id from content where status = 'Inactive'),
    bad_seasons as (select season_id from seasons where content_id in (from gone)),
    bad_episodes as (select episode_id from episodes where season_id in (from bad_seasons))
    select 'content' as "table", cast(content_id as varchar) as id from content where content_id not in (from gone)
    union all select 'seasons', cast(season_id as varchar) from seasons where content_id not in (from gone)
    union all select 'episodes', cast(episode_id as varchar) from episodes where season_id not in (from bad_seasons)
    union all select 'content_parts', cast(part_id as varchar) from content_parts where content_id not in (from gone)
    union all select 'content_genres', content_id || '-' || genre_id from content_genres where content_id not in (from gone)
    union all select 'content_languages', cast(content_language_id as varchar) from content_languages where content_id not in (from gone)
    union all select 'content_cast', cast(cast_id as varchar) from content_cast where content_id not in (from gone)
    union all select 'content_availability', cast(availability_id as varchar) from content_availability where content_id not in (from gone)
    union all select 'ratings', cast(rating_id as varchar) from ratings where content_id not in (from gone)
        and coalesce(season_id not in (from bad_seasons), true) and coalesce(episode_id not in (from bad_episodes), true)
    union all select 'watch_history', cast(watch_id as varchar) from watch_history where content_id not in (from gone)
    union all select 'my_list', cast(my_list_id as varchar) from my_list where content_id not in (from gone)
    union all select 'downloads', cast(download_id as varchar) from downloads where content_id not in (from gone)""",
    "d13_delete_profiles": """with gone as (select profile_id from profiles where is_kids and not is_primary)
    select 'profiles' as "table", cast(profile_id as varchar) as id from profiles where profile_id not in (from gone)
    union all select 'ratings', cast(rating_id as varchar) from ratings where profile_id not in (from gone)
    union all select 'watch_history', cast(watch_id as varchar) from watch_history where profile_id not in (from gone)
    union all select 'my_list', cast(my_list_id as varchar) from my_list where profile_id not in (from gone)
    union all select 'downloads', cast(download_id as varchar) from downloads where profile_id not in (from gone)
    union all select 'search_history', cast(search_id as varchar) from search_history where profile_id not in (from gone)
    union all select 'profile_preferences', cast(preference_id as varchar) from profile_preferences where profile_id not in (from gone)
    union all select 'profile_preferred_genres', profile_id || '-' || genre_id from profile_preferred_genres
        where profile_id not in (from gone)""",
    "d13_delete_devices": """with gone as (select device_id from user_devices where user_id % 3 = 0)
    select 'user_devices' as "table", cast(device_id as varchar) as id from user_devices where device_id not in (from gone)
    union all select 'downloads', cast(download_id as varchar) from downloads where device_id not in (from gone)""",
    "d13_delete_blocked": """with gone as (select user_id from users where account_status = 'pending')
    select 'subscriptions' as child, 'user_id' as "column", count(*) as "references" from subscriptions
    where user_id in (from gone) having count(*) > 0
    union all
    select 'payments', 'user_id', count(*) from payments where user_id in (from gone) having count(*) > 0""",
    "d14_delete_keys": """
    select watch_history.* from watch_history join profiles using (profile_id) join users using (user_id)
    where account_status <> 'suspended'""",
    "v9_overlaps": """with w as (
        select id, content_id, l_returnflag as country, cast(l_shipdate as date) as f,
               case when l_quantity < 50 then cast(l_shipdate as date) + cast(l_quantity - 1 as int)
                    else date '9999-12-31' end as u
        from li where l_quantity > 1)
    select 'content_availability' as "table", 'windows_do_not_overlap' as rule, count(*) as violations
    from w where exists (
        select 1 from w o where o.content_id = w.content_id and o.country = w.country and o.u > w.f
                            and (o.f < w.f or (o.f = w.f and o.id < w.id)))""",
    "v9_overlapping_rows": """with w as (
        select id, content_id, l_returnflag as country, cast(l_shipdate as date) as f,
               case when l_quantity < 50 then cast(l_shipdate as date) + cast(l_quantity - 1 as int) end as t,
               coalesce(t, date '9999-12-31') as u
        from li where l_quantity > 1)
    select id as availability_id, content_id, country as country_code, f as available_from, t as available_to
    from w where exists (
        select 1 from w o where o.content_id = w.content_id and o.country = w.country and o.u > w.f
                            and (o.f < w.f or (o.f = w.f and o.id < w.id)))""",
    "v10_profiles_over_limit": """
    select subscriptions.* from subscriptions join subscription_plans using (plan_id)
    where status = 'active'
      and (select count(*) from profiles p where p.user_id = subscriptions.user_id) > max_profiles""",
}

_OWNER = {
    "season_id": "seasons",
    "episode_id": "(select episode_id, content_id from episodes join seasons using (season_id))",
    "part_id": "content_parts",
}


def _cross_count(rule: quality.Rule) -> str:
    if rule.name == "profiles_within_plan":
        return f"select count(*) from ({BODIES['v10_profiles_over_limit']})"
    if rule.name == "parts_only_for_movies":
        return "select count(*) from content_parts join content using (content_id) where content_type <> 'Movie'"
    if rule.name == "device_in_plan":
        return """select count(*) from user_devices d join subscriptions s on s.user_id = d.user_id
            and s.status = 'active' where (s.plan_id, d.device_type) not in
            (select (plan_id, device_type) from plan_allowed_devices)"""
    level = rule.columns[1]
    return f"""select count(*) from {rule.table} r join {_OWNER[level]} o on o.{level} = r.{level}
        where o.content_id <> r.content_id"""


def _count(rule: quality.Rule, named: str = "{}") -> str:
    """``named`` says what the tables are called that are counted in place of the derived ones."""
    table = named.format(rule.table)
    given = " and ".join(f"{c} is not null" for c in rule.columns)
    if rule.kind == "row":
        body = f"select count(*) from {table} where not coalesce({rule.valid}, true)"
    elif rule.kind == "unique":
        keys = ", ".join(rule.columns)
        body = f"""select coalesce(cast(sum(n) as bigint), 0) from (select count(*) as n from {table}
            where {given} and {rule.where or 'true'} group by {keys} having count(*) > 1)"""
    elif rule.kind == "reference":
        parent, key = named.format(rule.parent[0]), rule.parent[1]
        body = f"""select count(*) from {table} c where {given}
            and not exists (select 1 from {parent} p where p.{key} = c.{rule.columns[0]})"""
    elif rule.kind == "overlap":
        body = """select count(*) from content_availability w where exists (
            select 1 from content_availability o where o.content_id = w.content_id
            and o.country_code = w.country_code and coalesce(o.available_to, date '9999-12-31') > w.available_from
            and (o.available_from < w.available_from
                 or (o.available_from = w.available_from and o.availability_id < w.availability_id)))"""
    else:
        body = _cross_count(rule)
    return f"""select '{rule.table}' as "table", '{rule.name.replace("'", "''")}' as rule, ({body}) as violations"""


def _checks(kind: str) -> str:
    def there(rule: quality.Rule) -> bool:
        have = set(DERIVED_COLUMNS[rule.table])
        return {*rule.columns, *rule.needs} <= have and (not rule.parent or rule.parent[1] in DERIVED_COLUMNS[rule.parent[0]])

    return "\nunion all ".join(_count(r) if there(r) else _unknown(r) for r in quality_rules(kind))


def _unknown(rule: quality.Rule) -> str:
    name = rule.name.replace("'", "''")
    return f"""select '{rule.table}' as "table", '{name}' as rule, cast(null as bigint) as violations"""


def _seeded(kind: str) -> str:
    wanted = quality_rules(kind)
    named = dict.fromkeys(t for r in wanted for t in (r.table, *(r.parent or ())[:1]))
    views = ", ".join(f"seeded_{t} as materialized ({seeded.statement(t, DERIVED_COLUMNS)})" for t in named)
    return f"with {views} " + "\nunion all ".join(_count(r, "seeded_{}") for r in wanted)


def statements() -> dict[str, str]:
    bodies = {**BODIES, "d01_merge_upsert_small": BODIES["d01_merge_upsert"], **{f"{kind}_rules": _checks(kind) for kind in quality.KINDS}}
    bodies |= {f"{kind}_seeded": _seeded(kind) for kind in SEEDED}
    return {name: with_views(body) for name, body in bodies.items()}
