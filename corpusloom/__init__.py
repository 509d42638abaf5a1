"""corpusloom: curation and evaluation of text corpora on PySpark."""
