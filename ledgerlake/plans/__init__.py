"""Tables users read: staging, star schema, marts, diagnostics, and the batch that builds them."""
