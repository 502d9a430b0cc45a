"""Tables in, tables out."""
