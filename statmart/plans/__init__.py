"""End-to-end plans, registered queries and their SQL oracle."""
