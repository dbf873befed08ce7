"""Where data comes from: JDBC, warehouse tables, and the star-schema adapter."""
