"""The order event contract: messages, checks and the stream that consumes them."""
