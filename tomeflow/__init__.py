"""tomeflow: documents and configuration files to a searchable knowledge base, as Spark plans."""
