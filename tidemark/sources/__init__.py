"""Reading landed JSON payloads and lake tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass
class Landing:
    """Rows of a landing, and the counts of what they leave out: a table whose long columns are summed up."""

    rows: DataFrame
    rejects: DataFrame


# One JSON array per file. A file that is not valid JSON fails the source, rather than losing its rows.
JSON_ARRAY_FILE = {"multiLine": "true", "mode": "FAILFAST"}
