"""Where rows come from and go to: feeds, payloads, tables and the test feed."""
