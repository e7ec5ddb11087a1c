"""Column expressions over the JSON text of a message.

A message is parsed once, into variants, which keep the JSON type of each field
and tell an absent key (SQL null) from a JSON null (variant VOID). Only a text
that this parse refuses is looked at again. Text after the object makes a message
malformed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

BAD = "_bad_text"

# What the producers' parser lets through and Spark's does not by default, and
# the other way round.
PARSE_OPTIONS = {
    "columnNameOfCorruptRecord": BAD,
    "allowUnquotedControlChars": "true",
    "allowNumericLeadingZeros": "true",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# Quarantine reasons, in the order in which they are tested.
REASONS = (
    "NULL_MESSAGE",
    "MALFORMED_JSON",
    "ROOT_NOT_OBJECT",
    "EID_NOT_STRING",
    "PASSPORT_NULL",
    "PASSPORT_NOT_OBJECT",
    "SID_NOT_STRING",
    "USERID_NOT_STRING",
)


@dataclass(frozen=True)
class SessionPath:
    """Where the session id sits: ``passport.sid`` or, in flat messages, ``sid``."""

    parent: str | None
    leaf: str

    @classmethod
    def of(cls, path: str) -> SessionPath:
        parent, _, leaf = path.rpartition(".")
        if not leaf or "." in parent:
            raise ValueError(f"a session path has one or two names: {path!r}")
        return cls(parent or None, leaf)

    @property
    def root_key(self) -> str:
        return self.parent or self.leaf


def _sealed(value: Column, fields: str) -> Column:
    """The message between two seals, read as three objects of an array, in one parse.

    A parser stops at the end of an object, whatever follows. Here a seal follows and one goes
    before: they are the first and last of three elements only if the text held exactly one value,
    so text after an object breaks them. The seal is the message's own digest, which no text
    contains by chance.
    """
    seal = F.concat(F.lit('{"eid":"'), _seal(value), F.lit('"}'))
    sealed = F.concat(F.lit('{"m":['), seal, F.lit(","), value, F.lit(","), seal, F.lit("]}"))
    return F.from_json(sealed, f"m array<struct<{fields}>>, {BAD} string", PARSE_OPTIONS)


def _seal(value: Column) -> Column:
    return F.hex(F.xxhash64(value))


def opened(sealed: Column, value: Column) -> Column:
    """The message's own fields, null where the text is anything but one JSON object."""
    read = lambda n: F.try_variant_get(sealed["m"][n]["eid"], "$", "string")
    whole = sealed[BAD].isNull() & (F.size(sealed["m"]) == 3) & (read(0) == _seal(value)) & (read(2) == _seal(value))
    return F.when(whole, sealed["m"][1])


def parse(value: Column, path: SessionPath) -> Column:
    """The three fields as variants, sealed; ``opened`` gives them out."""
    return _sealed(value, f"eid: variant, `{path.root_key}`: variant, userId: variant")


def parse_again(value: Column, doc: Column, path: SessionPath) -> Column:
    """Second look at a refused text of the nested form, sealed.

    A variant refuses an object that repeats a key. Read as a struct the parent
    object takes the last of them, as it does at the root.
    """
    fields = f"eid: variant, `{path.parent}`: struct<`{path.leaf}`: variant>, userId: variant"
    return F.when(doc.isNull() & value.isNotNull(), _sealed(value, fields))


def _kind(variant: Column) -> Column:
    return F.schema_of_variant(variant)


def _not_text(variant: Column) -> Column:
    """The key is there and holds something other than a string or null."""
    return variant.isNotNull() & ~_kind(variant).isin("STRING", "VOID")


def _text(variant: Column) -> Column:
    return F.variant_get(variant, "$", "string")


def flat_fields(doc: Column, path: SessionPath) -> Column:
    """``struct(eid, parent, sid, user, usable)`` of a message with the id at its root."""
    return F.struct(
        doc["eid"].alias("eid"),
        F.lit(None).cast("variant").alias("parent"),
        doc[path.leaf].alias("sid"),
        doc["userId"].alias("user"),
        doc.isNotNull().alias("usable"),
    )


def nested_fields(doc: Column, again: Column, path: SessionPath) -> Column:
    """The same of a message with the id in a parent object, from whichever parse read it."""
    late = again.isNotNull()
    parent = doc[path.parent]
    sid = F.try_variant_get(parent, f"$.{path.leaf}", "variant")
    return F.struct(
        F.when(late, again["eid"]).otherwise(doc["eid"]).alias("eid"),
        F.when(~late, parent).alias("parent"),
        F.when(late, again[path.parent][path.leaf]).otherwise(sid).alias("sid"),
        F.when(late, again["userId"]).otherwise(doc["userId"]).alias("user"),
        (late | doc.isNotNull()).alias("usable"),
    )


def reason(value: Column, f: Column, path: SessionPath) -> Column:
    """Why a message yields no event; null if it does. The first match wins."""
    rule = (
        F.when(value.isNull(), "NULL_MESSAGE")
        .when(~f["usable"] & F.try_parse_json(value).isNull(), "MALFORMED_JSON")
        .when(~f["usable"], F.when(F.json_object_keys(value).isNull(), "ROOT_NOT_OBJECT").otherwise("MALFORMED_JSON"))
        .when(_not_text(f["eid"]), "EID_NOT_STRING")
    )
    if path.parent is not None:
        # The parent's own type matters only where it holds no session id.
        rule = rule.when(
            f["sid"].isNull() & f["parent"].isNotNull() & (_kind(f["parent"]) == "VOID"),
            f"{path.parent.upper()}_NULL",
        ).when(
            f["sid"].isNull() & f["parent"].isNotNull() & ~_kind(f["parent"]).startswith("OBJECT"),
            f"{path.parent.upper()}_NOT_OBJECT",
        )
    return rule.when(_not_text(f["sid"]), f"{path.leaf.upper()}_NOT_STRING").when(
        _not_text(f["user"]), "USERID_NOT_STRING"
    )


def texts(f: Column) -> dict[str, Column]:
    """The event's columns. An absent session id is the empty text; JSON null stays null."""
    return {
        "eid": _text(f["eid"]),
        "sessionId": F.when(f["sid"].isNull(), "").otherwise(_text(f["sid"])),
        "userId": _text(f["user"]),
    }
