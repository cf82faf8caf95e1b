"""Site specifications, tables, sinks and catalog set-up."""
