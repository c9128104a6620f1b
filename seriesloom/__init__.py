"""Monthly demand analytics over many (Product, Division) series, as Spark jobs."""
