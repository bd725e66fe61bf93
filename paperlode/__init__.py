"""Document-corpus analytics on Spark: page records, headings, dosing signals, edition comparison,
clinical review and reproducible reports, each as a plain DataFrame -> DataFrame function."""
