"""DataFrame operators: listing, detail, incremental load, quality, URL checks."""
