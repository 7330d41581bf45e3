"""Model training, scoring and evaluation: tables in, tables out."""
