"""Where rows come from: files, tables, databases, Kafka, and the derived test tables."""
