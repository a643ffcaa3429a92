"""Nothing streams here: tables are read version by version. A table that grows is followed by SchemaProvider."""
