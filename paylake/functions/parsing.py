"""Parsers that give NULL instead of an error."""

from __future__ import annotations

# Accepted shapes of a time text and how each is read, the ISO form
# first.  "-" in fifth place tells the ISO form from all others.
ISO_SHAPE = "substring({text}, 5, 1) = '-' AND length({text}) >= 8"
ISO_READING = "try_cast({text} AS timestamp)"
EPOCH_SHAPES = [
    (r"^\d{9,10}$", "timestamp_seconds(try_cast({text} AS bigint))"),
    (r"^\d{13}$", "timestamp_millis(try_cast({text} AS bigint))"),
]
# What other texts are read by, after a weekday, commas and the blank before AM or PM are taken out.
TIME_SHAPES = [
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{14}$", "yyyyMMddHHmmss"),
    (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
    (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$", "dd/MM/yyyy HH:mm"),
    (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$", "dd/MM/yyyy HH:mm:ss"),
    (r"^\d{2}/\d{2}/\d{4} \d{1,2}:\d{2}:\d{2}[AaPp][Mm]$", "dd/MM/yyyy h:mm:ssa"),
    (r"^\d{2}\.\d{2}\.\d{4}$", "dd.MM.yyyy"),
    (r"^\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}:\d{2}$", "dd.MM.yyyy HH:mm:ss"),
    (r"^\d{2}-\d{2}-\d{4}$", "dd-MM-yyyy"),
    (r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$", "dd-MM-yyyy HH:mm:ss"),
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
    (r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$", "yyyy/MM/dd HH:mm:ss"),
    (r"^\d{4}/\d{2}/\d{2} \d{1,2}:\d{2}:\d{2}[AaPp][Mm]$", "yyyy/MM/dd h:mm:ssa"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}$", "d MMM yyyy HH:mm:ss"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4} \d{2}:\d{2}:\d{2}$", "d MMMM yyyy HH:mm:ss"),
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{3} \d{1,2} \d{4} \d{2}:\d{2}:\d{2}$", "MMM d yyyy HH:mm:ss"),
    (r"^[A-Za-z]{4,9} \d{1,2} \d{4}$", "MMMM d yyyy"),
]
TAKEN_OUT = r"^[A-Za-z]{3,9}, ?|,| (?=[AaPp][Mm]$)"
# Numbers below 10**18, those of 19 digits, and the largest of them that is a long.
UINT, UINT_19, MOST = r"^0*[0-9]{1,18}\z", r"^0*[1-9][0-9]{18}\z", 2**63 - 1


def blank_to_null(text: str) -> str:
    return f"nullif({text}, '')"


def parse_uint(text: str) -> str:
    """Digits only, as a long; anything else, also above 2**63-1, gives NULL.

    The cast alone would also take a sign and surrounding blanks.  It is tried on numbers that
    fit only: inside, a cast that fails is an exception, which costs more than reading the row.
    """
    fits = f"{text} RLIKE r'{UINT}' OR {text} RLIKE r'{UINT_19}' AND right({text}, 19) <= '{MOST}'"
    return f"CASE WHEN {fits} THEN try_cast({text} AS bigint) END"


def parse_timestamp(text: str) -> str:
    """Lenient time parser with second resolution; unreadable text gives NULL.

    The ISO form, by far the most common, costs one test and one cast.  Of the other forms only
    the pattern is chosen by cases, and read in one place: the code that Spark generates stays
    small enough to be compiled.  The default cast never sees forms such as ``12:00`` that it
    would complete with the current date.
    """
    plain = f"regexp_replace({text}, r'{TAKEN_OUT}', '')"
    patterns = " ".join(f"WHEN {plain} RLIKE r'{shape}' THEN '{pattern}'" for shape, pattern in TIME_SHAPES)
    epochs = " ".join(f"WHEN {text} RLIKE r'{shape}' THEN {reading.format(text=text)}" for shape, reading in EPOCH_SHAPES)
    iso = f"WHEN {ISO_SHAPE} THEN {ISO_READING}".format(text=text)
    return (
        f"date_trunc('second', CASE {iso} {epochs} "
        f"ELSE try_to_timestamp({plain}, CASE {patterns} END) END)"
    )


def iso_seconds(text: str) -> str:
    """A time text brought to ``yyyy-MM-ddTHH:mm:ss`` in UTC, or NULL."""
    return f"date_format({parse_timestamp(f'trim({text})')}, \"yyyy-MM-dd'T'HH:mm:ss\")"
