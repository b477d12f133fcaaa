"""The stateful fold and the streaming queries around it."""
