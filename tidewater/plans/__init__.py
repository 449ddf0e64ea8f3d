"""Silver/gold views, audit queries and the registered stand-in queries."""
