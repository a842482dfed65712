"""What a user asks for: compositions of operators."""
