"""Structure checks on message arrays.

A declared schema cannot tell a missing key from a NULL, so raw JSON text is checked
through VARIANT and typed columns by the rules a type leaves open.
"""

from pyspark.sql import Column, functions as F

from turnmill.functions.binding import bind

# The roles a message may have.
ROLES = ("user", "assistant", "system")


def validate_messages(messages: Column) -> Column:
    """At least two messages, every role known.  Never NULL."""
    ok = (F.array_size(messages) >= 2) & F.forall(messages, lambda m: F.coalesce(m["role"].isin(*ROLES), F.lit(False)))
    return F.coalesce(ok, F.lit(False))


def variant_items(sample: Column) -> Column:
    """The elements of ``$.messages``, or NULL when that is not a list."""
    return F.try_variant_get(sample, "$.messages", "array<variant>")


def variant_has_key(item: Column, key: str) -> Column:
    """Whether an object has ``key``, even with a null value; false for anything else."""
    # A JSON null is a VARIANT, not a NULL.
    return F.variant_get(item, f"$.{key}", "variant").isNotNull()


def variant_role(item: Column) -> Column:
    """The role as text; what is no string gives text that is no role, or NULL."""
    return F.try_variant_get(item, "$.role", "string")


def validate_messages_json(value: Column) -> Column:
    """The messages check on a line of JSON text.  Never NULL; malformed text fails.

    Content must be present but may be null or of any type; further keys are allowed.
    """

    def item_ok(item: Column) -> Column:
        return variant_has_key(item, "content") & F.coalesce(variant_role(item).isin(*ROLES), F.lit(False))

    def items_ok(items: Column) -> Column:
        return (F.array_size(items) >= 2) & F.forall(items, item_ok)

    return F.coalesce(bind(F.try_parse_json(value), lambda sample: bind(variant_items(sample), items_ok)), F.lit(False))


def content_rules(messages: Column) -> Column:
    """Both a user and an assistant turn occur and no content is empty.  Never NULL."""
    roles = messages["role"]
    ok = (
        F.array_contains(roles, "user")
        & F.array_contains(roles, "assistant")
        & F.forall(messages["content"], lambda c: F.coalesce(F.length(c) > 0, F.lit(False)))
    )
    return F.coalesce(ok, F.lit(False))
