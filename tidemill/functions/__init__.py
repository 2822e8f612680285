"""Column functions: text formatting, prompts, completion parsing, rewards."""
