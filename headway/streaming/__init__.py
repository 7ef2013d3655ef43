"""The same jobs over streams. Every checkpoint lives beside the table it feeds."""
