"""Registered query plans over the driver tables (``queries()``), and the
equivalent DuckDB SQL (``oracle``).  Each plan reads whole tables; inputs
the reference fetched from the web (feeds, names, responses) are derived
from table columns by Spark, identically in the SQL."""
