"""The music-store configuration: registry, rules, cleaning, dimensions, contracts.

Everything here is data. The values marked as fixed define the results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleaning import Step, defaults, lower, to_timestamps
from ..operators.contracts import Contract, Reference
from ..operators.quality import Rule, make_rules
from ..operators.scd2 import Versioned

# Source tables and the file names recorded with them.
REGISTRY = [
    ("Album", "album.csv"),
    ("Artist", "artist.csv"),
    ("Customer", "customer.csv"),
    ("Employee", "employee.csv"),
    ("Genre", "genre.csv"),
    ("Invoice", "invoice.csv"),
    ("InvoiceLine", "invoiceline.csv"),
    ("MediaType", "mediatype.csv"),
    ("Playlist", "playlist.csv"),
    ("PlaylistTrack", "playlisttrack.csv"),
    ("Track", "track.csv"),
]

# The checks of each table.
RULES: dict[str, list[dict]] = {
    "invoice": [
        {"col": "InvoiceId", "check": "not_null", "criticality": "error"},
        {"col": "CustomerId", "check": "not_null", "criticality": "error"},
        {"col": "InvoiceDate", "check": "not_null", "criticality": "error"},
        {"col": "Total", "check": "not_null", "criticality": "warn"},
        {"col": "Total", "check": "min_value", "criticality": "warn", "min_val": 0},
    ],
    "invoiceline": [
        {"col": "InvoiceLineId", "check": "not_null", "criticality": "error"},
        {"col": "InvoiceId", "check": "not_null", "criticality": "error"},
        {"col": "TrackId", "check": "not_null", "criticality": "error"},
        {"col": "Quantity", "check": "not_null", "criticality": "error"},
        {"col": "Quantity", "check": "min_value", "criticality": "error", "min_val": 1},
    ],
    "customer": [
        {"col": "CustomerId", "check": "not_null", "criticality": "error"},
        {"col": "Email", "check": "not_null_and_not_empty", "criticality": "warn"},
    ],
    "track": [
        {"col": "TrackId", "check": "not_null", "criticality": "error"},
        {"col": "Name", "check": "not_null", "criticality": "error"},
    ],
    "album": [
        {"col": "AlbumId", "check": "not_null", "criticality": "error"},
        {"col": "Title", "check": "not_null", "criticality": "error"},
    ],
    "artist": [
        {"col": "ArtistId", "check": "not_null", "criticality": "error"},
    ],
    "genre": [
        {"col": "GenreId", "check": "not_null", "criticality": "error"},
    ],
    "mediatype": [
        {"col": "MediaTypeId", "check": "not_null", "criticality": "error"},
    ],
    "employee": [
        {"col": "EmployeeId", "check": "not_null", "criticality": "error"},
    ],
    "playlist": [
        {"col": "PlaylistId", "check": "not_null", "criticality": "error"},
    ],
    "playlisttrack": [
        {"col": "PlaylistId", "check": "not_null", "criticality": "error"},
        {"col": "TrackId", "check": "not_null", "criticality": "error"},
    ],
}

# Cleaning beyond the trim that every table gets.
CLEANING: dict[str, list[Step]] = {
    "customer": [lower("Email"), defaults({"Company": "Individual", "Fax": "N/A"})],
    "invoice": [to_timestamps("InvoiceDate")],
    "employee": [to_timestamps("BirthDate", "HireDate")],
}


@dataclass(frozen=True)
class Dimension:
    name: str
    source: str
    key: str
    columns: dict[str, str | tuple[str, ...]]  # target -> source, the natural key first

    @property
    def natural_key(self) -> str:
        return next(iter(self.columns))

    @property
    def mapping(self) -> dict:
        """Several source columns are joined by a space, skipping NULLs."""
        return {
            target: source if isinstance(source, str) else F.concat_ws(" ", *source)
            for target, source in self.columns.items()
        }


# The dimensions, their sources and keys, target and source columns.
DIMENSIONS = [
    Dimension(
        "dim_artist",
        "artist",
        "artist_key",
        {
            "artist_id": "ArtistId",
            "artist_name": "Name",
        },
    ),
    Dimension(
        "dim_genre",
        "genre",
        "genre_key",
        {
            "genre_id": "GenreId",
            "genre_name": "Name",
        },
    ),
    Dimension(
        "dim_mediatype",
        "mediatype",
        "media_type_key",
        {
            "media_type_id": "MediaTypeId",
            "media_type_name": "Name",
        },
    ),
    Dimension(
        "dim_album",
        "album",
        "album_key",
        {
            "album_id": "AlbumId",
            "album_title": "Title",
            "artist_id": "ArtistId",
        },
    ),
    Dimension(
        "dim_track",
        "track",
        "track_key",
        {
            "track_id": "TrackId",
            "track_name": "Name",
            "album_id": "AlbumId",
            "media_type_id": "MediaTypeId",
            "genre_id": "GenreId",
            "composer": "Composer",
            "duration_ms": "Milliseconds",
            "file_size_bytes": "Bytes",
            "unit_price": "UnitPrice",
        },
    ),
    Dimension(
        "dim_employee",
        "employee",
        "employee_key",
        {
            "employee_id": "EmployeeId",
            "employee_name": ("FirstName", "LastName"),
            "title": "Title",
            "reports_to_employee_id": "ReportsTo",
            "birth_date": "BirthDate",
            "hire_date": "HireDate",
            "city": "City",
            "country": "Country",
            "email": "Email",
        },
    ),
    Dimension(
        "dim_playlist",
        "playlist",
        "playlist_key",
        {
            "playlist_id": "PlaylistId",
            "playlist_name": "Name",
        },
    ),
    Dimension(
        "dim_customer",
        "customer",
        "customer_key",
        {
            "customer_id": "CustomerId",
            "first_name": "FirstName",
            "last_name": "LastName",
            "company": "Company",
            "address": "Address",
            "city": "City",
            "state": "State",
            "country": "Country",
            "postal_code": "PostalCode",
            "phone": "Phone",
            "fax": "Fax",
            "email": "Email",
            "support_rep_id": "SupportRepId",
        },
    ),
]

_INT, _LONG, _TEXT, _FLAG = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()
_DAY, _TIME = T.DateType(), T.TimestampType()

# The Gold tables, as columns with type and whether NULL is allowed,
# primary key, greatest lengths of texts, and references.
CONTRACTS = [
    Contract(
        "dim_date",
        T.StructType(
            [
                T.StructField("date_key", _INT, False),
                T.StructField("full_date", _DAY, False),
                T.StructField("year", _INT, False),
                T.StructField("quarter", _INT, False),
                T.StructField("month", _INT, False),
                T.StructField("month_name", _TEXT, False),
                T.StructField("day_of_month", _INT, False),
                T.StructField("day_of_week", _INT, False),
                T.StructField("day_name", _TEXT, False),
                T.StructField("is_weekend", _FLAG, False),
            ]
        ),
        ("date_key",),
        {
            "month_name": 20,
            "day_name": 20,
        },
    ),
    Contract(
        "dim_artist",
        T.StructType(
            [
                T.StructField("artist_key", _LONG, False),
                T.StructField("artist_id", _INT, False),
                T.StructField("artist_name", _TEXT, True),
            ]
        ),
        ("artist_key",),
        {
            "artist_name": 200,
        },
    ),
    Contract(
        "dim_album",
        T.StructType(
            [
                T.StructField("album_key", _LONG, False),
                T.StructField("album_id", _INT, False),
                T.StructField("album_title", _TEXT, False),
                T.StructField("artist_id", _INT, False),
            ]
        ),
        ("album_key",),
        {
            "album_title": 300,
        },
        (
            Reference("artist_id", "dim_artist", "artist_id"),
        ),
    ),
    Contract(
        "dim_genre",
        T.StructType(
            [
                T.StructField("genre_key", _LONG, False),
                T.StructField("genre_id", _INT, False),
                T.StructField("genre_name", _TEXT, True),
            ]
        ),
        ("genre_key",),
        {
            "genre_name": 120,
        },
    ),
    Contract(
        "dim_mediatype",
        T.StructType(
            [
                T.StructField("media_type_key", _LONG, False),
                T.StructField("media_type_id", _INT, False),
                T.StructField("media_type_name", _TEXT, True),
            ]
        ),
        ("media_type_key",),
        {
            "media_type_name": 120,
        },
    ),
    Contract(
        "dim_track",
        T.StructType(
            [
                T.StructField("track_key", _LONG, False),
                T.StructField("track_id", _INT, False),
                T.StructField("track_name", _TEXT, False),
                T.StructField("album_id", _INT, True),
                T.StructField("media_type_id", _INT, False),
                T.StructField("genre_id", _INT, True),
                T.StructField("composer", _TEXT, True),
                T.StructField("duration_ms", _INT, True),
                T.StructField("file_size_bytes", _INT, True),
                T.StructField("unit_price", T.DecimalType(10, 2), False),
            ]
        ),
        ("track_key",),
        {
            "track_name": 300,
            "composer": 300,
        },
        (
            Reference("album_id", "dim_album", "album_id"),
            Reference("media_type_id", "dim_mediatype", "media_type_id"),
            Reference("genre_id", "dim_genre", "genre_id"),
        ),
    ),
    Contract(
        "dim_customer",
        T.StructType(
            [
                T.StructField("customer_key", _LONG, False),
                T.StructField("customer_id", _INT, False),
                T.StructField("first_name", _TEXT, False),
                T.StructField("last_name", _TEXT, False),
                T.StructField("company", _TEXT, True),
                T.StructField("address", _TEXT, True),
                T.StructField("city", _TEXT, True),
                T.StructField("state", _TEXT, True),
                T.StructField("country", _TEXT, True),
                T.StructField("postal_code", _TEXT, True),
                T.StructField("phone", _TEXT, True),
                T.StructField("fax", _TEXT, True),
                T.StructField("email", _TEXT, False),
                T.StructField("support_rep_id", _INT, True),
                T.StructField("effective_start_date", _DAY, False),
                T.StructField("effective_end_date", _DAY, True),
                T.StructField("is_current", _FLAG, False),
            ]
        ),
        ("customer_key",),
        {
            "first_name": 100,
            "last_name": 100,
            "company": 200,
            "address": 200,
            "city": 100,
            "state": 100,
            "country": 100,
            "postal_code": 20,
            "phone": 50,
            "fax": 50,
            "email": 200,
        },
    ),
    Contract(
        "dim_employee",
        T.StructType(
            [
                T.StructField("employee_key", _LONG, False),
                T.StructField("employee_id", _INT, False),
                T.StructField("employee_name", _TEXT, False),
                T.StructField("title", _TEXT, True),
                T.StructField("reports_to_employee_id", _INT, True),
                T.StructField("birth_date", _TIME, True),
                T.StructField("hire_date", _TIME, True),
                T.StructField("city", _TEXT, True),
                T.StructField("country", _TEXT, True),
                T.StructField("email", _TEXT, True),
            ]
        ),
        ("employee_key",),
        {
            "employee_name": 200,
            "title": 100,
            "city": 100,
            "country": 100,
            "email": 200,
        },
    ),
    Contract(
        "dim_playlist",
        T.StructType(
            [
                T.StructField("playlist_key", _LONG, False),
                T.StructField("playlist_id", _INT, False),
                T.StructField("playlist_name", _TEXT, True),
            ]
        ),
        ("playlist_key",),
        {
            "playlist_name": 200,
        },
    ),
    Contract(
        "fact_sales",
        T.StructType(
            [
                T.StructField("invoice_line_id", _LONG, False),
                T.StructField("invoice_id", _LONG, False),
                T.StructField("customer_key", _LONG, False),
                T.StructField("track_key", _LONG, False),
                T.StructField("date_key", _INT, False),
                T.StructField("support_rep_key", _LONG, True),
                T.StructField("quantity", _INT, False),
                T.StructField("unit_price", T.DecimalType(10, 2), False),
                T.StructField("line_total", T.DecimalType(10, 2), False),
                T.StructField("billing_country", _TEXT, True),
                T.StructField("billing_city", _TEXT, True),
            ]
        ),
        ("invoice_line_id",),
        {
            "billing_country": 100,
            "billing_city": 100,
        },
        (
            Reference("customer_key", "dim_customer", "customer_key"),
            Reference("track_key", "dim_track", "track_key"),
            Reference("date_key", "dim_date", "date_key"),
            Reference("support_rep_key", "dim_employee", "employee_key"),
        ),
    ),
    Contract(
        "fact_sales_customer_agg",
        T.StructType(
            [
                T.StructField("customer_key", _LONG, False),
                T.StructField("total_invoices", _LONG, False),
                T.StructField("total_quantity", _LONG, False),
                T.StructField("total_revenue", T.DecimalType(14, 2), False),
                T.StructField("avg_line_total", T.DecimalType(14, 4), True),
                T.StructField("last_purchase_date_key", _INT, True),
                T.StructField("customer_id", _INT, True),
                T.StructField("first_name", _TEXT, True),
                T.StructField("last_name", _TEXT, True),
                T.StructField("country", _TEXT, True),
                T.StructField("email", _TEXT, True),
            ]
        ),
        ("customer_key",),
        {
            "first_name": 100,
            "last_name": 100,
            "country": 100,
            "email": 200,
        },
        (
            Reference("customer_key", "dim_customer", "customer_key"),
        ),
    ),
]


def registry_entries() -> list[tuple[str, str]]:
    return list(REGISTRY)


def rules(table: str) -> list[Rule]:
    """The rules of a table; none for an unknown one."""
    return make_rules(RULES.get(table, []))


def dimensions() -> dict[str, Dimension]:
    return {d.name: d for d in DIMENSIONS}


def contracts() -> dict[str, Contract]:
    return {c.name: c for c in CONTRACTS}


def customer_versions() -> Versioned:
    """All customer attributes are tracked."""
    customer = dimensions()["dim_customer"]
    key, *tracked = customer.columns
    return Versioned(customer.key, key, tuple(tracked))
