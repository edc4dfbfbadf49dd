"""Suites for the staged and mart models (fixed values of their declared tests)."""

from __future__ import annotations

from lakeops.operators.checks import EMAIL_REGEX, Expectation as E, Suite

POSTS_SUITE = Suite(
    "api_posts_suite",
    (
        E("row_count_between", kwargs={"low": 1, "high": 1_000_000}),
        E("columns_match_ordered_list", kwargs={"columns": ["post_id", "user_id", "title", "body", "loaded_at"]}),
        E("not_null", "post_id"),
        E("unique", "post_id"),
        E("not_null", "user_id"),
        E("type_in_list", "user_id", {"types": ["INTEGER", "BIGINT", "int64", "int32"]}),
        E("not_null", "title"),
        E("length_between", "title", {"low": 1, "high": 500}),
        E("not_null", "body"),
        E("length_between", "body", {"low": 1, "high": 10_000}),
        E("not_null", "loaded_at"),
        E("of_type", "loaded_at", {"type": "TIMESTAMP"}),
    ),
)

USERS_SUITE = Suite(
    "api_users_suite",
    (
        E("row_count_between", kwargs={"low": 1, "high": 100_000}),
        E(
            "columns_match_set",
            kwargs={
                "columns": [
                    "user_id", "user_name", "username", "email", "phone", "website",
                    "address_json", "company_json", "loaded_at",
                ]
            },
        ),
        E("not_null", "user_id"),
        E("unique", "user_id"),
        E("not_null", "username"),
        E("unique", "username"),
        E("not_null", "email"),
        E("unique", "email"),
        E("matches_regex", "email", {"regex": EMAIL_REGEX}),
        E("length_between", "email", {"low": 5, "high": 255}),
        E("not_null", "loaded_at"),
    ),
)

USER_POSTS_SUITE = Suite(
    "fct_user_posts",
    (
        E("unique", "user_id"),
        E("not_null", "user_id"),
        E("not_null", "user_name"),
        E("not_null", "username"),
        E("unique", "username"),
        E("not_null", "email"),
        E("unique", "email"),
        E("not_null", "total_posts"),
        E("values_between", "total_posts", {"low": 0}),
        E("values_between", "max_post_length", {"low": 0, "high": 10_000}),
        E("values_between", "min_post_length", {"low": 0, "high": 10_000}),
        E("not_null", "calculated_at"),
    ),
)
