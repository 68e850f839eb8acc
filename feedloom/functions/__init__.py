"""Column expression builders (``Column -> Column``), all JVM-side."""
