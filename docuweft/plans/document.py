"""Document tables. Titles, labels and column names are fixed values."""

from ..functions.text import prose, title
from .spec import TAKE, TableSpec, lookup

SPECS = (
    TableSpec(
        "drive", "document",
        copies={"file_name": "title", "drive_type": "type"},
        lookups=(lookup("user", "created_by", company=TAKE),),
        title=title("Document File", "file_name"),
        text=prose("document file", "file name, drive type, mime type, file extension"),
    ),
)
