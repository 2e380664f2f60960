"""Tables: definitions, writes, and maintenance."""
