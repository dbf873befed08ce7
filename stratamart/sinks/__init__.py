"""Where results go: warehouse tables, JDBC result tables, event topics."""
