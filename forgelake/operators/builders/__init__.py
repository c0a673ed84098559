"""Entity builders: staged records and current tables in, next tables out."""
