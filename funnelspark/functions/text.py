"""Text cleaning (FN-2, FN-5, FN-7, FN-9, FN-10, FN-14, FN-15, FN-26)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at either end of a field.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The event types the warehouse knows.
EVENT_TYPES = (
    "INVITE_SENT",
    "ACCEPTED",
    "MESSAGE_SENT",
    "REPLY_RECEIVED",
    "MEETING_BOOKED",
    "WITHDRAWN",
    "FAILED",
)

# Source spelling (lower case, words joined by "_") and the event type it means.
EVENT_TYPE_ALIASES = {
    "invite_sent": "INVITE_SENT",
    "invitation_sent": "INVITE_SENT",
    "sent": "INVITE_SENT",
    "accepted": "ACCEPTED",
    "connected": "ACCEPTED",
    "connection_accepted": "ACCEPTED",
    "message_sent": "MESSAGE_SENT",
    "message": "MESSAGE_SENT",
    "reply_received": "REPLY_RECEIVED",
    "replied": "REPLY_RECEIVED",
    "reply": "REPLY_RECEIVED",
    "meeting_booked": "MEETING_BOOKED",
    "meeting": "MEETING_BOOKED",
    "withdrawn": "WITHDRAWN",
    "failed": "FAILED",
    "error": "FAILED",
}


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column, max_length: int | None = None) -> Column:
    """Stripped text; NULL for NULL, for the bare word ``null`` and for nothing but white space."""
    text = blank_to_null(strip(F.nullif(c, F.lit("null"))))
    return text if max_length is None else F.substring(text, 1, max_length)


def first_filled(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty (white space and ``null`` count as filled)."""
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def event_type_of(c: Column) -> Column:
    """Canonical event type; an unknown spelling stays, upper-cased, for the validity check to find."""
    text = strip(c)
    known = F.create_map(*[F.lit(word) for pair in EVENT_TYPE_ALIASES.items() for word in pair])
    return blank_to_null(F.coalesce(F.try_element_at(known, F.translate(F.lower(text), " -", "__")), F.upper(text)))


def is_unknown_type(event_type: Column) -> Column:
    """NULL (not true) for a NULL type, as SQL's ``NOT IN`` has it."""
    return ~event_type.isin(*EVENT_TYPES)


def full_name(name: Column, first: Column, last: Column) -> Column:
    """Given name, else first and last joined; NULL when all are missing."""
    joined = blank_to_null(strip(F.concat_ws(" ", blank_to_null(first), blank_to_null(last))))
    return F.coalesce(clean_text(name, 255), joined)


def crm_lead_status(status: Column) -> Column:
    """Lead status from free text; the earlier line wins."""
    text = F.lower(status)
    return (
        F.when(text.contains("connect"), "CONNECTED")
        .when(text.contains("invite") | text.contains("sent"), "INVITE_SENT")
        .when(text.contains("enrich"), "ENRICHED")
        .otherwise("CAPTURED")
    )


def status_label(status: Column) -> Column:
    return F.when(status == "active", "Active").when(status == "paused", "Paused").otherwise("Ghost")


def csv_cells(line: Column) -> Column:
    """Cells of one CSV line as an array; a quoted cell may hold commas and doubled quotes."""
    # Every match starts with a comma, so an empty cell is a match too.
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("[^"]*(?:""[^"]*)*"|[^,]*)'), F.lit(1))
    unquoted = lambda c: F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.when(c.startswith('"') & (F.length(c) > 1), unquoted(c)).otherwise(c))
